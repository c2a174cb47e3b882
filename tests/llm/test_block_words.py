"""A block of the language model looks each word up once and keeps its place."""

from collections import Counter

import numpy as np

from daymart.llm import ppm
from daymart.llm.common import lower_words


def test_places_counts_and_scores():
    rows = [(1, "The mill, the MILL the", False), (2, None, False), (3, "the yard", True), (None, "", False), (4, "the\tmill,", False)]
    block = ppm.Block(rows)
    tokens = [[*lower_words(text), b""] for _, text, _ in rows]
    words = sorted(block.place)
    assert words == sorted({w for t in tokens for w in t})
    known = Counter(w for t, row in zip(tokens, rows) if not row[2] for w in t)
    assert dict(zip(words, block.known()[block.places(words)].tolist())) == {w: known[w] for w in words}
    value = np.empty(len(words))
    for _, own in ppm.dealt_words(block.place, 3):
        value[block.places(own)] = [len(w) for w in own]
    assert [value[at].tolist() for at in block.tokens] == [[len(w) for w in t] for t in tokens]
