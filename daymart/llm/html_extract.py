"""Main text of web pages by tree scoring.

A small tolerant parser builds the element tree (raw-text elements, void elements, implied ends of paragraphs, list
items and cells, unclosed and stray tags). Elements that are never content (navigation, page headers and footers,
asides, forms, scripts, and what class, id or role names call so) are left out, but not by a name that also says
content, or by a doubtful one on prose. If names leave a page without a sentence, they said nothing of its parts and are
ignored, except those of reader comments, which never are content, in an article element neither. Every paragraph-like block passes
points for its length and commas to its parent, half to its grandparent and less further up; a container's points
are discounted by the share of its text that lies in links. The best container is kept, or the article or main
element around it if few of that one's characters are links, without such lists, tables and sections in it beside the
best container that are mostly links. Beside the container so found stay siblings that score well, paragraphs of prose,
headings, lists, tables, preformatted text and figures with few links. The kept blocks' texts are joined in page order.

The reading is one pass per page, in a narrow map. Null and empty pages give an empty text. Pages of any length are
parsed whole; elements are walked with explicit stacks, so nesting may be of any depth. Repeated rows give
repeated results; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from daymart.llm.common import batches

SCHEMA = "page_id long, url string, text string, n_chars long"
_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

# HTML element classes.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes template".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
             "samp small span strike strong sub sup time tt u var wbr".split())
ENDS_P = set("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure "
             "footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul".split())
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
           "tfoot": {"tr", "td", "th", "tbody", "thead"}}
SCOPE = set("article section div ul ol dl table td th body html main blockquote".split())
# What is never content, by element, role and words of class or id.
NEVER = RAW | set("nav aside form button select svg canvas object menu dialog head footer audio video map math".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
NAMES = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|adbox|adslot|banner|breadcrumbs?|combx|comments?|commentlist|"
                   r"consent|cookies?|disqus|disclaimer|footer|gdpr|masthead|menu\w*|modal|nav\w*|newsletter|"
                   r"notices?|pager|pagination|popup|promo\w*|related|remark|replies|rss|share\w*|shoutbox|"
                   r"sidebar\w*|signup|skyscraper|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[\s_-])", re.I)
KEEP = set("html body".split())
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|"
                 r"<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
# Names that also begin or end words of articles (related-work, social-policy): inside a longer name they are a doubt.
DOUBT = re.compile(r"(?:banner|disclaimer|notices?|related|remark|replies|share\w*|social|widget)$", re.I)
CONTENT = re.compile("(?:content|post|article|body|entry|main|story)$", re.I)
STATE = re.compile("(?:has|with|without|no|is|not)[_-]", re.I)  # has-sidebar says something of the page, not of this part
# Names of reader comments: content in no case, also beside a name that says content.
COMMENTS = re.compile(r"(?:comments?(?:[_-](?:area|body|content|entry|items?|list|section|text|thread|wrapper))?|commentlist|"
                      r"disqus\w*|(?:reader|user)[_-]comments?|replies|shoutbox)$", re.I)
ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
BASE = {"article": 25, "main": 20, "section": 5, "div": 5, "td": 3, "blockquote": 3, "pre": 3, "form": -3, "ul": -3,
        "ol": -3, "dl": -3, "table": -3}
SENTENCE = re.compile(r"[.!?](\s|$)")
GROUPS = set("ul ol dl table div section".split())
BESIDE = set("ul ol dl table pre figure figcaption blockquote".split())
HEADING = re.compile("h[1-6]")


class Node:
    __slots__ = ("tag", "kids", "parent", "depth", "dropped", "holds_block")

    def __init__(self, tag: str, parent: Node | None, dropped: bool):
        self.tag, self.parent, self.dropped, self.holds_block = tag, parent, dropped, False
        self.kids: list = []
        self.depth = parent.depth + 1 if parent else 0
        if tag not in INLINE:
            while parent is not None and not parent.holds_block:  # nodes above know already
                parent.holds_block, parent = True, parent.parent


class Open:
    """The open elements, and how many there are of each tag."""

    def __init__(self, root: Node):
        self.nodes, self.count = [root], {root.tag: 1}

    def push(self, node: Node) -> None:
        self.nodes.append(node)
        self.count[node.tag] = self.count.get(node.tag, 0) + 1

    def cut(self, at: int) -> None:
        for node in self.nodes[at:]:
            self.count[node.tag] -= 1
        del self.nodes[at:]

    def close(self, tag: str, scope: set[str] | None = None) -> None:
        """Close the innermost element of a tag; not beyond an element of ``scope``, by default for inline tags only."""
        if not self.count.get(tag):
            return
        for k in range(len(self.nodes) - 1, 0, -1):
            here = self.nodes[k].tag
            if here == tag:
                self.cut(k)
                return
            if here in (scope if scope is not None else SCOPE) and (scope is not None or tag in INLINE or tag == "p"):
                return


def _named(word: str) -> int:
    """What a class or id says: 2 for a part that is no content, 1 for a doubt."""
    if STATE.match(word) or not NAMES.search(word):
        return 0
    parts = re.split("[_-]", word)
    listed = [w for w in parts if NAMES.search(w)]
    return 1 if len(listed) < len(parts) and all(map(DOUBT.match, listed)) else 2


def _unwanted(tag: str, attributes: str, opened: Open, by_name: bool) -> int:
    """2: left out; 1: left out unless it holds prose."""
    if tag in NEVER:
        return 2
    if tag == "header":  # a page's header; one inside the article holds its title
        return 0 if opened.count.get("article") or opened.count.get("main") else 2
    if not attributes or tag in KEEP:
        return 0
    named, called = 0, False
    for name, *values in ATTR.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            if any(map(COMMENTS.match, value.split())):
                return 2
            named = max([named, *map(_named, value.split())])
            called = called or any(map(CONTENT.match, value.split()))
        if name == "role" and value.strip().lower() in ROLES:
            return 2
        if name == "aria-hidden" and value.strip().lower() == "true":
            return 2
        if name == "hidden":
            return 2
    return 0 if called or not by_name else named


def parse(page: str, by_name: bool = True) -> Node:
    """The element tree of a page; text is kept as it stands in the source, references undecoded. ``by_name``: leave out
    what its class or id calls something else than content."""
    root = Node("html", None, False)
    opened, at, end = Open(root), 0, len(page)
    doubts: list[Node] = []
    while at < end:
        m, top = TAG.search(page, at), opened.nodes[-1]
        if m is None:
            top.kids.append(page[at:])
            break
        if m.start() > at:
            top.kids.append(page[at:m.start()])
        at = m.end()
        if m[1]:
            opened.close(m[1].lower())
        elif m[2]:
            tag = m[2].lower()
            if tag in ENDS_P and opened.count.get("p"):
                opened.close("p")
            for old in IMPLIED.get(tag, ()):
                opened.close(old, SCOPE - {"td", "th"} if tag in ("tr", "tbody", "tfoot") else SCOPE)
            if tag in ("html", "body") and len(opened.nodes) == 1:
                continue
            top = opened.nodes[-1]
            unwanted = _unwanted(tag, m[3], opened, by_name)
            node = Node(tag, top, top.dropped or unwanted == 2)
            if unwanted == 1 and not node.dropped:
                doubts.append(node)
            top.kids.append(node)
            if tag in RAW:
                stop = re.compile(f"</{re.escape(tag)}\\b[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else end if tag in ("script", "style") else at
            elif tag not in VOID and not m[3].rstrip().endswith("/"):
                opened.push(node)
    for node in reversed(doubts):  # inner ones first
        blocks = _blocks(node)
        links, chars = sum(b[2] for b in blocks), sum(len(b[1]) for b in blocks)
        node.dropped = links >= 0.25 * chars or not any(len(b[1]) > 80 and SENTENCE.search(b[1]) for b in blocks)
    return root


def _blocks(root: Node) -> list[tuple[Node, str, int]]:
    """(element, text, characters in links) of every run of inline content, in page order, dropped parts left out."""
    out: list[tuple[Node, str, int]] = []
    run: list[str] = []
    links = 0

    def flush(owner: Node) -> None:
        nonlocal links
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            out.append((owner, text, min(links, len(text))))
        run.clear()
        links = 0

    frames = [(iter(root.kids), root, False, None)]  # kids, owner of their text, in a link, whom to flush behind them
    while frames:
        kids, owner, link, behind = frames[-1]
        for kid in kids:
            if isinstance(kid, str):
                run.append(kid)
                links += len(kid.strip()) if link else 0
            elif kid.dropped:
                if kid.tag not in INLINE:
                    flush(owner)
            elif kid.tag == "br":
                run.append("\n")
            elif kid.tag in INLINE and not kid.holds_block:
                frames.append((iter(kid.kids), owner, link or kid.tag == "a", None))
                break
            else:
                flush(owner)
                own = kid if kid.tag not in INLINE else owner
                frames.append((iter(kid.kids), own, link or kid.tag == "a", own))
                break
        else:
            frames.pop()
            if behind is not None:
                flush(behind)
    flush(root)
    return out


def _score(blocks: list[tuple[Node, str, int]]) -> dict[Node, list[float]]:
    """container: [points, characters, characters in links]."""
    found: dict[Node, list[float]] = {}
    for owner, text, links in blocks:
        heading = HEADING.fullmatch(owner.tag)
        points = 0.0 if heading else (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - links / len(text))
        node, share, level = owner.parent or owner, 1.0, 0
        if owner.tag not in ("p", "li", "td", "th", "pre", "dd", "dt") and not heading and owner.parent:
            node = owner  # text that stands in a container itself
        while node is not None:
            got = found.setdefault(node, [BASE.get(node.tag, 0), 0, 0])
            got[0] += points * share
            got[1] += len(text)
            got[2] += links
            level += 1
            share = 0.5 if level == 1 else 1 / (level * 3)
            node = node.parent
    return found


def _upward(node: Node | None):
    while node is not None:
        yield node
        node = node.parent


def _enclosing(node: Node) -> Node | None:
    """The closest article around an element, or else the closest main."""
    around = list(_upward(node))
    return next((n for tag in ("article", "main") for n in around if n.tag == tag), None)


def _sizes(blocks: list[tuple[Node, str, int]]) -> dict[Node, tuple[int, int]]:
    """(characters, characters in links) of every element that holds text."""
    out: dict[Node, tuple[int, int]] = {}
    for owner, text, links in blocks:
        for node in _upward(owner):
            chars, linked = out.get(node, (0, 0))
            out[node] = chars + len(text), linked + links
    return out


def main_text(page: str | None) -> str:
    """The article of a page: its blocks, white space made single, joined by line ends."""
    if not page:
        return ""
    blocks = _blocks(parse(page))
    if not any(SENTENCE.search(text) and links < len(text) for _, text, links in blocks):
        blocks = _blocks(parse(page, by_name=False))
    if not blocks:
        return ""
    found = _score(blocks)
    value = {n: points * (1 - links / max(1, chars)) for n, (points, chars, links) in found.items()}
    best = max(found, key=lambda n: (value[n], n.depth))
    least = max(10.0, value[best] * 0.2)
    size = _sizes(blocks)
    dense = lambda node: size[node][1] / max(1, size[node][0])
    whole = _enclosing(best)
    cut: set[Node] = set()
    if whole is not None and dense(whole) < 0.4:
        path = set(_upward(best))
        cut = {n for n in size if n.tag in GROUPS and n not in path and best not in _upward(n)
               and whole in _upward(n) and dense(n) > 0.5}
        best = whole
    kept = {best}
    if best.parent is not None:
        own = {owner: (text, links) for owner, text, links in blocks}
        for sibling in best.parent.kids:
            if isinstance(sibling, str) or sibling is best or sibling not in size:
                continue
            if sibling in value and sibling.tag not in ("p", "ul", "ol", "table") and value[sibling] >= least:
                kept.add(sibling)
            elif sibling.tag == "p" and sibling in own:
                text, links = own[sibling]
                if len(text) > 80 and links < 0.25 * len(text) or not links and SENTENCE.search(text):
                    kept.add(sibling)
            elif (sibling.tag in BESIDE or HEADING.fullmatch(sibling.tag)) and dense(sibling) < 0.25:
                kept.add(sibling)
    inside: dict[Node, bool] = {}

    def within(node: Node) -> bool:
        path = []
        while node is not None and node not in inside:
            path.append(node)
            if node in cut or node in kept:
                inside[node] = node not in cut
                break
            node = node.parent
        result = node is not None and inside[node]
        inside.update((n, result) for n in path)
        return result

    return "\n".join(text for owner, text, _ in blocks if within(owner))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def rows(found):
        for batch in found:
            for page, url, source in zip(*(c.to_pylist() for c in batch.columns)):
                text = main_text(source)
                yield page, url, text, len(text)

    def run(found):
        yield from batches(rows(found), _ARROW, 1024)

    return pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                        pages["html"].cast("string").alias("html")).mapInArrow(run, SCHEMA)
