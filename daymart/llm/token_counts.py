"""Exact token counts of a SentencePiece BPE model at every prefix, by dynamic programming.

A BPE encoding has two properties that make it a prefix recurrence: the encoding of a text is the only token
sequence in which every two neighbours are *compatible* (encoding their concatenation gives those two tokens), and
a leading part of an encoding is the encoding of that prefix. So the encoding of ``w[:i]`` ends in the one token
``t`` that is compatible with the last token of ``w[:i-len(t)]``, and::

    count[i] = count[i - len(t)] + 1,   last[i] = t

``PrefixCounter.states`` fills that table for a unit in one pass, and any truncation or budget question reads it. No piece of such a model holds a space mark after another character,
hence runs of space marks plus the word behind them are independent units and counts add up over units; a
character that no piece holds is written as its UTF-8 bytes, one token each, and separates what is around it.

Nulls and empty texts have 0 tokens. Texts of any length are walked whole, a unit at a time. Repeated rows give
repeated results; other columns are not read.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from daymart.llm.common import batches

MARK = "▁"
UNIT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
PAIRS = 1_000_000
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, limit_chars long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                    ("over_limit", pa.bool_()), ("limit_chars", pa.int64())])


class _Units(dict):
    """Token count per unit text; a miss asks the recurrence. Emptied when full, so its memory is bounded."""

    def __init__(self, counter: PrefixCounter, prefix: str, size: int = 600_000):
        super().__init__()
        self.counter, self.prefix, self.size = counter, prefix, size

    def __missing__(self, word: str) -> int:
        if len(self) >= self.size:
            self.clear()
        n = self[word] = self.counter.states(self.prefix + word)[-1]
        return n


class PrefixCounter:
    """The prefix recurrence over one model's pieces."""

    def __init__(self, model_path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        if sp.decode(sp.encode("a  b ａ")) != "a  b ａ":
            raise ValueError("the model changes texts before it encodes them")
        plain = [i for i in range(sp.get_piece_size())
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        self.pieces = ["", *self.score]
        if not {c for p in self.score for c in p} <= set(self.score):
            raise ValueError("a character of a piece is no piece itself")
        if any(MARK in p.lstrip(MARK) for p in self.score):
            raise ValueError("a piece holds a space mark inside; units would not be independent")
        if any("\n" in p for p in self.score):
            raise ValueError("pieces hold line ends; lines would not be independent")
        # an automaton that names all pieces ending at each position in one walk
        self.tokens_in = ahocorasick.Automaton()
        for k, piece in enumerate(self.pieces[1:], 1):
            self.tokens_in.add_word(piece, (k, len(piece)))
        self.tokens_in.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.after, self.first = _Units(self, MARK), _Units(self, "")

    def merge(self, text: str) -> list[str]:
        """The model's merges on a short text: the best-scored neighbouring pair first, the left one of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, token: int) -> bool:
        """Whether ``token`` may follow ``left`` in an encoding (0: a start or a byte-written character)."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        a, b = self.pieces[left], self.pieces[token]
        ok = self.pairs[left << 20 | token] = self.merge(a + b) == ([a, b] if a else [b]) and (
            not a or self.merge(b) == [b])
        return ok

    def states(self, unit: str) -> list[int]:
        """Token counts of every prefix of a unit, the empty one first."""
        n = len(unit)
        counts, lasts, pairs = [-1] * (n + 1), [0] * (n + 1), self.pairs
        counts[0] = done = 0  # ``done``: the last prefix that has its state
        for end, (token, size) in self.tokens_in.iter(unit):
            end += 1
            while done < end - 1:  # characters without a piece: one token a byte
                counts[done + 1] = counts[done] + len(unit[done].encode("utf-8", "surrogatepass"))
                done += 1
            if counts[end] < 0:
                j = end - size
                ok = pairs.get(lasts[j] << 20 | token)
                if ok or ok is None and self.compatible(lasts[j], token):
                    counts[end], lasts[end], done = counts[j] + 1, token, end
        for i in range(done, n):
            counts[i + 1] = counts[i] + len(unit[i].encode("utf-8", "surrogatepass"))
        return counts

    def units(self, text: str):
        """The independent units of a text, space marks written out; line ends stand alone."""
        for k, line in enumerate(text.split("\n")):
            if k:
                yield "\n"
            yield from UNIT.findall((MARK if k == 0 else "") + line.replace(" ", MARK))

    def count(self, text: str) -> int:
        """Tokens of a whole text, as the library gives them."""
        if not text:
            return 0
        if "  " in text or text[0] == " " or MARK in text:
            return sum(self.first[u] for u in self.units(text))
        lines = text.split("\n")
        total = len(lines) - 1
        for k, line in enumerate(lines):
            words = line.split(" ")
            if k:
                total += self.first[words[0]]
                del words[0]
            total += sum(map(self.after.__getitem__, words))
        return total

    def within(self, text: str, budget: int) -> int:
        """Code points of the longest prefix of ``text`` that has at most ``budget`` tokens."""
        done, chars = 0, -1  # the mark before the text is not one of its characters
        for unit in self.units(text) if text else ():
            n = self.first[unit]
            if done + n > budget:
                best = max(i for i, k in enumerate(self.states(unit)) if done + k <= budget)
                return max(0, chars + best)
            done, chars = done + n, chars + len(unit)
        return max(0, chars)

    def prefix_counts(self, text: str) -> list[int]:
        """Exact token count of ``text[:i]`` for every i from 0 to its length."""
        out, done = [0], 0
        for k, unit in enumerate(self.units(text) if text else ()):
            counts = self.states(unit)
            out += [done + n for n in counts[1 + (k == 0):]]
            done += counts[-1]
        return out


_counters: dict[str, PrefixCounter] = {}


def counter(model_path: str) -> PrefixCounter:
    """One counter per worker process and model."""
    if model_path not in _counters:
        _counters[model_path] = PrefixCounter(model_path)
    return _counters[model_path]


def count_tokens(docs: DataFrame, model_path: str, budget: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: bytes, exact tokens, whether they exceed ``budget`` and the longest prefix that fits it (code
    points). A narrow map: no shuffle, nothing but the model's path is sent."""

    def rows(found):
        c = counter(model_path)
        for batch in found:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                n = c.count(text)
                yield (doc, len(text.encode("utf-8", "surrogatepass")), n, n > budget,
                       c.within(text, budget) if n > budget else len(text))

    def run(found):
        yield from batches(rows(found), _ARROW)

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")) \
        .mapInArrow(run, SCHEMA)
