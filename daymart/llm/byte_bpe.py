"""Token ids of a byte-level BPE vocabulary."""

from __future__ import annotations

import json

import numpy as np
import tiktoken

# How byte-level BPE vocabularies write bytes as characters (printable bytes stand for themselves, the
# others follow from 256 on), and the pattern that cuts texts into pre-tokens.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in set(_SHOWN)]
BYTE_OF = {chr(b): b for b in _SHOWN} | {chr(256 + k): b for k, b in enumerate(_HIDDEN)}
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteBpe:
    """Ids as the library gives them for ``vocabulary`` (a tokenizers JSON file), special strings included."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(BYTE_OF[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
        self.bpe = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return self.bpe.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)

    def plain(self, text: str) -> list[int]:
        """Ids of a text whose special strings are ordinary text."""
        return self.bpe.encode_ordinary(text)


_open: dict[str, ByteBpe] = {}


def byte_bpe(vocabulary: str) -> ByteBpe:
    """One encoder per worker process and vocabulary."""
    if vocabulary not in _open:
        _open[vocabulary] = ByteBpe(vocabulary)
    return _open[vocabulary]
