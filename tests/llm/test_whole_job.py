"""Cases in which an operator once did less than its whole job."""

import math
import random
import zlib
from collections import Counter, defaultdict

from daymart.llm import chat, html_extract, minhash_join, ppm, queries
from tests.llm import brute


def plain_ppm(train, others):
    """Scores of texts by a model of every context of ``train``, from dictionaries."""
    def steps(text):
        raw = ppm.stream(ppm.lower_words(text))
        return [(raw[i - ppm.ORDER:i], raw[i]) for i in range(ppm.ORDER, len(raw))]

    orders = range(ppm.ORDER + 1)
    node = [defaultdict(Counter) for _ in orders]
    for text in train:
        for context, symbol in steps(text):
            for k in orders:
                node[k][context[ppm.ORDER - k:]][symbol] += 1
    state = lambda total, types: (int(math.log2(total) * 4), min(types, 63))
    novel, every = Counter(), Counter()
    for k in orders:
        for seen in node[k].values():
            total, types = sum(seen.values()), len(seen)
            for n in seen.values():
                if total > 1:
                    novel[k, state(total - 1, types - (n == 1))] += n == 1
                    every[k, state(total - 1, types - (n == 1))] += n
    known = {}

    def cost(context, symbol, k):
        if k < 0:
            return 1 / 256
        context = context[len(context) - k:]
        if (context, symbol) not in known:
            known[context, symbol] = value(context, symbol, k)
        return known[context, symbol]

    def value(context, symbol, k):
        if context not in node[k]:
            return cost(context, symbol, k - 1)
        seen = node[k][context]
        total, types = sum(seen.values()), len(seen)
        at = k, state(total, types)
        escape = (novel[at] + ppm.PRIOR * types / (total + types)) / (every[at] + ppm.PRIOR)
        if symbol in seen:
            return seen[symbol] / total * (1 - escape)
        return escape * cost(context, symbol, k - 1) / (1 - sum(cost(context, s, k - 1) for s in seen))

    return [sum(math.log10(cost(c, s, ppm.ORDER)) for c, s in steps(text)) for text in others]


def test_lm_scoring_keeps_every_context(spark):
    queries.settle(spark)
    draw = random.Random(1)
    texts = {i: "".join(draw.choices("abcdefghij \u00e4", k=9000)) for i in range(12)}
    texts[20], texts[21] = texts[3][:4000], "xyz never seen \u65e5"
    train = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    assert len({g for t in train for g in zip(*(t[k:] for k in range(6)))}) > 50_000 and len(train) < len(texts)
    got = {r.doc_id: r.score for r in ppm.score(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    for i, want in zip(texts, plain_ppm(train, texts.values())):
        assert abs(got[i] - want) <= 1e-6 * abs(want)


PROSE = "The river rose in the night, and by the morning the lower road, the mill and the yard stood under water. "


def test_names_that_hold_the_article_are_kept():
    filler = f"<p>{PROSE}first</p><p>{PROSE}second</p>"
    for attributes in ('class="content has-sidebar"', 'id="related-work"', 'class="social-policy"', 'data-x="so hidden a"',
                       'class="sidebar"', 'title="a hidden gem"'):
        got = html_extract.main_text(f"<body><div {attributes}>{filler}</div></body>")
        assert got.split("\n") == [f"{PROSE}first", f"{PROSE}second"], attributes
    inner = f'<article>{filler}<section id="related-work"><p>{PROSE}third</p></section><p title="a hidden gem">{PROSE}</p>'
    assert len(html_extract.main_text(inner + "</article>").split("\n")) == 4
    for attributes in ("hidden", 'hidden=""', 'class="related-posts"', 'class="sidebar"', 'id="site-footer"'):
        got = html_extract.main_text(f"<article>{filler}<div {attributes}><p>Other <a>things</a></p></div></article>")
        assert "Other" not in got, attributes


def test_parts_beside_the_paragraphs_are_kept():
    links = "".join(f'<li><a href="x">Another page of the site {i}</a></li>' for i in range(9))
    for n in (1, 3, 10, 40):
        paragraphs = "".join(f"<p>{PROSE * 3}{i}</p>" for i in range(n))
        parts = "<h1>Title</h1>", f"<div><h2>Part</h2>{paragraphs}</div>", "<ul><li>one<li>two</ul>", "<pre>code()</pre>", \
            "<table><tr><td>3<td>4</table>", "<figure><figcaption>A view</figcaption></figure>", "<p>Short"
        want = ["Title", "Part", *(f"{PROSE * 3}{i}" for i in range(n)), "one", "two", "code()", "3", "4", "A view"]
        for page in ("<article>{}</article>", "<main><div>{}</div></main>", "<article><section>{}</section></article>"):
            got = html_extract.main_text("<body><ul>" + links + "</ul>" + page.format("".join(parts)) + "</body>")
            assert got.split("\n") == [*want, "Short"], (n, page)
            assert html_extract.main_text(page.format("".join(parts) + f"<ul>{links}</ul>")).split("\n")[:len(want)] == want
        if n > 1:
            got = html_extract.main_text("<div>" + "".join(parts[:-1]) + f"<ul>{links}</ul></div>")
            assert [t for t in got.split("\n") if "Another" not in t] == want, n


def test_a_conversation_without_an_id_is_formatted(spark):
    rows = [(None, 0, "user", "alone"), (None, 1, "assistant", "yes"), (1, 0, "user", "other")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    nodes, members = chat.format_chats(df, queries.tokenizer("byte_bpe_50k.json"))
    got = members.join(chat.read_back(nodes, queries.tokenizer("byte_bpe_50k.json")), "path").collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256) for r in got} == {c: x[:2] for c, x in brute.chats(rows).items()}


def test_texts_without_an_id_do_not_all_meet(spark):
    draw = random.Random(2)
    texts = [" ".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=40)) for _ in range(60)]
    rows = [(None, t) for t in texts] + [(None, t + " one") for t in texts] + [(None, texts[0])] * 5 + [(7, texts[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = minhash_join.sets_of(df, 2, 4).groupBy("set_id").agg({"text_hash": "min"}).toDF("set_id", "text_hash")
    sets = minhash_join._full_sets(df, wanted.selectExpr("set_id", "cast(null as long) first_id", "text_hash"), 2)
    assert sets.count() == 120
    plan = sets._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan
    got = minhash_join.near_duplicates(df, words=2).collect()
    assert len(got) == len(rows)
    assert sorted(r.component_id for r in got if r.component_id is not None) == [7, 7, 7]
