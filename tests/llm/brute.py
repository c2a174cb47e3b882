"""Plain versions of the operators, for small tables."""

import hashlib
import html
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def words(text):
    return [w for w in re.split(rb"[ \t-\r]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())) if w]


def shingles(text, n):
    w = words(text)
    return {tuple(w)} - {()} if len(w) < n else {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def classes(nodes, links):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def near_duplicates(rows, n, percent=80):
    """{doc_id: (set size, component, kept)} of (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t, n) for i, t in rows}
    by = defaultdict(list)
    for i in sorted(sets, key=lambda i: len(sets[i])):
        by[len(sets[i])].append(i)
    links = []
    for a in sets:
        for size in range(max(1, math.ceil(len(sets[a]) * percent / 100)), len(sets[a]) + 1) if sets[a] else ():
            for b in by.get(size, ()):
                if a != b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    links.append((a, b))
    top = classes(sets, links)
    return {i: (len(sets[i]), top[i], top[i] == i) for i in sets}


def near_vectors(rows, cosine=0.9):
    ok = {i: np.array(v, float) for i, v in rows
          if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    unit = {i: v / np.linalg.norm(v) for i, v in ok.items()}
    links = [(a, b) for a in unit for b in unit
             if a < b and len(unit[a]) == len(unit[b]) and float(unit[a] @ unit[b]) >= cosine]
    top = classes([i for i, _ in rows], links)
    n = Counter(x for pair in links for x in pair)
    return {i: (n[i], top[i], top[i] == i) for i, _ in rows}


def contamination(docs, items, n=5, percent=80):
    out = set()
    for doc, text in docs:
        have = {k: shingles_of(text, k) for k in range(1, n + 1)}
        for item, question in items:
            k = min(n, len((question or "").lower().split()))
            want = shingles_of(question, k) if k else set()
            common = len(want & have[k]) if k else 0
            if want and 100 * common >= percent * len(want):
                out.add((doc, item, len(want), common))
    return out


def shingles_of(text, n):
    w = re.split(r"[ \t-\r]+", (text or "").lower().strip(" \t\n\x0b\x0c\r"))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w != [""] else set()


def article(page):
    """Main text of the pages of the test tables: what their article element holds."""
    body = page[page.index("<article>") + 9:].split("</article>")[0]
    blocks = re.split(r"</?(?:p|h1)>", body.replace("<br>", " "))
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def warc(rows):
    pages = {i: (h or "").encode() for i, h in rows}
    best = {}
    for i, raw in pages.items():
        if len(raw) >= 1000:
            best[raw] = max(i, best.get(raw, i))
    out = {}
    for i, raw in pages.items():
        to = best.get(raw, i)
        out[i] = (len(raw), hashlib.sha1(raw).hexdigest(), "response" if to == i else "revisit", None if to == i else to)
    return out


def chats(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns = [t[1:] for t in sorted(turns)]
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out


def unigram(rows, modulus=7, held=2):
    fold = {i: zlib.crc32(str(i).encode()) % modulus == held for i, _ in rows}
    count = Counter()
    for i, t in rows:
        if not fold[i]:
            count.update([*words(t), b""])
    total, base = sum(count.values()), sum(count.values()) + len(count) + 1
    out = {}
    for i, t in rows:
        tokens = [*words(t), b""]
        out[i] = (fold[i], len(tokens), sum(count[w] > 0 for w in tokens), total,
                  sum(math.log10((count[w] + 1) / base) for w in tokens))
    return out
