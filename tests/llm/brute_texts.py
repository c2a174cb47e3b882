"""Plain versions of the conversation repair, the spelling variants and the line dedup."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

BLANKS = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def lines(rows, shortest=40, least=5):
    """{row number: (doc_id, n_lines, n_dropped, hash)} of rows (doc_id, text)."""
    holders = defaultdict(set)
    split = [(i, (t or "").split("\n")) for i, t in rows]
    for i, own in split:
        for line in own:
            key = lower(line.strip(BLANKS))
            if len(key) >= shortest:
                holders[key].add(i)
    out = []
    for i, own in split:
        kept = []
        for line in own:
            at = holders.get(lower(line.strip(BLANKS)), ())
            if len(at) < least or i == max(at):
                kept.append(line)
        out.append((i, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def variants(rows, shortest=7, least=2, ratio=10):
    """{word: (n, n_near, form, form_n, root)} of rows (doc_id, text)."""
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            if len(run) >= shortest:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= least}
    letters = sorted(set("".join(n)))
    form, near = {}, {}
    for w in n:
        edits = {w[:k] + w[k + 1:] for k in range(len(w))}
        edits |= {w[:k] + x + w[k + d:] for d in (0, 1) for k in range(len(w) + 1) for x in letters if k + d <= len(w)}
        found = [x for x in edits if x != w and x in n]
        near[w] = len(found)
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {w: (n[w], near[w], form[w], n.get(form[w]), root(w)) for w in n}


def cheapest(symbols):
    """(cost, letters): least cost, then least in ASCII, over every script. A symbol is (initial, cut off, must go)."""
    legal = re.compile("(s?(ua)+)?")
    best = {"": None}
    limit = [2 * len(symbols)]  # deleting all is legal

    def go(i, roles, cost, letters):
        if cost > limit[0]:
            return
        if i == len(symbols) and legal.fullmatch(roles):
            if best[""] is None or (cost, letters) < best[""]:
                best[""], limit[0] = (cost, letters), cost
        if i < len(symbols):
            initial, cut, must = symbols[i]
            go(i + 1, roles, cost + 2, letters + "D")
            if not must:
                if _opening(roles + (initial or "?")):
                    go(i + 1, roles + initial, cost + 5 * cut, letters + "K")
                for r in "ua":
                    if _opening(roles + r):
                        go(i + 1, roles + r, cost + 1 + 5 * cut, letters + "R")
        for r in "ua":
            if _opening(roles + r):
                go(i, roles + r, cost + 5, letters + "I")

    go(0, "", 0, "")
    return best[""]


def _opening(roles):
    return re.fullmatch("s?(ua)*u?", roles) is not None


def repairs(rows):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, hash)} of rows (conv_id, turn, role, text)."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        own = talks[conv]
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        own += [(turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    out = {}
    for conv, own in talks.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, symbols, faults = set(), [], Counter()
        for _, role, text in own:
            end = text.strip(BLANKS)[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            symbols.append((role[:1], fault == "truncated", fault in ("blank", "duplicate")))
        wrong = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, letters = cheapest(symbols)
        at, written = 0, []
        for letter in letters:
            expected = "assistant" if written and written[-1][0][:1] == "u" else "user"
            if letter == "I":
                written.append((expected, ""))
                continue
            if letter != "D":
                written.append((own[at][1] if letter == "K" else expected, own[at][2]))
            at += 1
        text = "\n".join(f"{r}:{t}" for r, t in written)
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], wrong, cost, letters,
                     hashlib.sha256(text.encode()).hexdigest())
    return out
