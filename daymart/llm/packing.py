"""Packing along a space-filling curve.

Every text becomes a hashed vector (square roots of its byte 4-gram counts), is projected to three dimensions and
gets the Hilbert index of its cell. A range sort by that index puts like texts next to each other; each sorted
partition is then one stream of tokens that is cut every ``length`` ids. What is left at a partition's end is cut
into sequences whose lengths are powers of two, so nothing is padded.

The index is a column function, so the sort moves each text once; the tokens are made behind the sort and only
pieces leave a task. A partition streams: memory holds one batch of texts and one open sequence, whatever its size.
Equal keys (copies) are spread by document id, which is part of the sort key. Null texts count as empty; a document
without text is the single end id. Null ids are kept; repeated rows are packed as often as they occur; other columns
are not read. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from daymart.llm.byte_bpe import byte_bpe
from daymart.llm.common import batches

DIMS, BITS, BUCKETS = 3, 16, 1024
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "curve_key long")
_ARROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                              "offset", "curve_key")])


def text_vectors(texts) -> np.ndarray:
    """One unit row per text: square roots of the counts of its hashed byte 4-grams."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for k, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if len(raw) >= 4:
            b = np.frombuffer(raw, np.uint8).astype(np.uint32)
            grams = b[:-3] | b[1:-2] << 8 | b[2:-1] << 16 | b[3:] << 24
            out[k] = np.sqrt(np.bincount(grams * np.uint32(2654435761) >> np.uint32(22), minlength=BUCKETS))
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def hilbert_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position of integer cells (rows of ``dims`` coordinates of ``bits`` bits) on the Hilbert curve.

    Bit by bit from the top: the cell's orthant in the current frame is the next digit (its Gray-code rank), and
    the frame for the bits below is turned by reflecting or exchanging axes, as the curve does.
    """
    x = [c.astype(np.int64) for c in cells.T]
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        bit, low = 1 << b, (1 << b) - 1
        for d in range(dims):
            inside = (x[d] & bit) > 0
            swap = np.where(inside, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(inside, x[0] ^ low, x[0] ^ swap)
            x[d] = x[d] ^ swap if d else x[0]
    for d in range(1, dims):
        x[d] = x[d] ^ x[d - 1]
    fix = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        fix = np.where((x[-1] & (1 << b)) > 0, fix ^ ((1 << b) - 1), fix)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | ((x[d] ^ fix) >> b & 1)
    return key


def curve_keys(texts) -> np.ndarray:
    axes = np.random.default_rng(7).standard_normal((BUCKETS, DIMS)).astype(np.float32)
    at = np.clip(text_vectors(texts) @ axes / 8 + 0.5, 0, 1)
    return hilbert_index((at * ((1 << BITS) - 1)).astype(np.int64))


@F.pandas_udf(LongType())
def _curve_key(texts: pd.Series) -> pd.Series:
    return pd.Series(np.concatenate([curve_keys(texts[i:i + 512].tolist()) for i in range(0, len(texts), 512)])
                     if len(texts) else np.empty(0, np.int64))


class Packer:
    """Cuts a stream of documents into sequences of ``length`` ids; ``finish`` cuts the rest by powers of two."""

    def __init__(self, length: int, first_id: int = 0):
        if length & (length - 1):
            raise ValueError("length must be a power of two")
        self.length, self.sequence, self.open, self.fill = length, first_id, [], 0

    def add(self, doc, key, ids: np.ndarray):
        at = 0
        while at < len(ids):
            take = min(len(ids) - at, self.length - self.fill)
            self.open.append((doc, at, ids[at:at + take], len(ids), key))
            self.fill, at = self.fill + take, at + take
            if self.fill == self.length:
                yield from self._close(self.length)

    def finish(self):
        while self.fill:
            yield from self._close(1 << self.fill.bit_length() - 1)

    def _close(self, size: int):
        offset, left = 0, []
        for doc, start, ids, total, key in self.open:
            here = ids[:size - offset]
            if len(here):
                yield (doc, start, len(here), zlib.crc32(here.tobytes()), total, self.sequence, offset, key)
            if len(here) < len(ids):
                left.append((doc, start + len(here), ids[len(here):], total, key))
            offset += len(here)
        self.open, self.fill, self.sequence = left, self.fill - size, self.sequence + 1


def pack(docs: DataFrame, vocabulary: str, length: int = 1024, end_id: int = 0, partitions: int | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document: where they lie in it, in which sequence and at which offset."""
    keyed = docs.select(docs[id_col].cast("long").alias("doc_id"),
                        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")) \
        .withColumn("curve_key", _curve_key("text"))
    order = ("curve_key", "doc_id")
    ranged = (keyed.repartitionByRange(partitions, *order) if partitions else keyed.repartitionByRange(*order)) \
        .sortWithinPartitions(*order, F.xxhash64("text"))

    def pieces(found):
        bpe, end = byte_bpe(vocabulary), np.array([end_id], "<u4")
        packer = Packer(length, TaskContext.get().partitionId() << 40)
        for batch in found:
            for doc, text, key in zip(*(c.to_pylist() for c in batch.columns)):
                yield from packer.add(doc, key, np.concatenate([bpe.ids(text), end]))
        yield from packer.finish()

    def run(found):
        yield from batches(pieces(found), _ARROW)

    return ranged.select("doc_id", "text", "curve_key").mapInArrow(run, SCHEMA)
