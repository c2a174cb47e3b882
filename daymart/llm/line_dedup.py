"""Line dedup: lines that many documents share stay in one document only.

Method. Two Bloom filters, of keys seen and of keys seen twice:

1. Every task fills its own pair while it reads documents: a key that is not in the first filter enters the first, a
   key that is there already enters the second. A document offers each of its keys once. The filters are cut into pages
   of ``PAGE`` bits; a key's bits all lie in one page, so tasks send only pages they touched, as bit positions while
   these are few. Pages of all tasks are merged as a stream, one page after another: the second filter takes what is in
   both first filters, so a key seen by two tasks is never missed.
2. The merged second filter is at most ``FILTER_BYTES`` at any input size; that is the size bound under which it is
   broadcast. Only lines whose key it holds are emitted (with the whole key, not a hash) and shuffled.
3. Exact: suspects are counted by key and document, keys found in at least ``least_docs`` documents keep their lines in
   the largest ``doc_id`` only. Counting combines before the shuffle, so a line that a third of all documents hold
   travels as one row a task; joining the decision back is an equi join, which adaptive execution splits.

A filter that is too small for the input only passes more suspects to step 3; no line is lost at any size. What is in
memory of a task: its pair of filters, one batch of documents, one page's merge.

Defined results. Null or empty text: one empty line. A document is its ``doc_id``: rows with one id count once, each row
loses or keeps its own lines. Rows without an id are documents by their text and smaller than all ids. Repeated rows are
handled alike and all returned. Extra columns, whatever their names, are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.llm.common import materialize, text_bytes

PAGE = 1 << 15  # bits
FILTER_BYTES = 32 << 20
HASHES = 4
BLANKS = " \t\n\x0b\x0c\r"
SENT = pa.schema([("page", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])
SUSPECT = pa.schema([("doc_id", pa.int64()), ("version", pa.int64()), ("key", pa.string()), ("lines", pa.list_(pa.int32()))])
SUSPECT_DDL = "doc_id long, version long, key string, lines array<int>"


def line_keys(text: str | None, shortest: int) -> dict[str, list[int]]:
    """Keys of at least ``shortest`` code points and the numbers of their lines."""
    found: dict[str, list[int]] = {}
    for at, line in enumerate((text or "").split("\n")):
        if len(line) >= shortest:
            key = line.strip(BLANKS)
            if len(key) >= shortest:
                found.setdefault(key.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"), []).append(at)
    return found


def key_hashes(keys) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(k.encode("utf-8", "surrogatepass")) for k in keys], np.uint64)


class Filter:
    """Bloom filter of ``pages`` pages (a power of two): a bit array."""

    def __init__(self, pages: int, bits: np.ndarray | None = None):
        self.pages = pages
        self.bits = np.zeros(pages * PAGE // 8, np.uint8) if bits is None else bits

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The bit numbers of each hash, a row of ``HASHES``."""
        page = (hashes >> np.uint64(40)) & np.uint64(self.pages - 1)
        step = (hashes >> np.uint64(16)) & np.uint64(0x7FFF) | np.uint64(1)
        inside = (hashes[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(PAGE - 1)
        return page[:, None] * np.uint64(PAGE) + inside

    def add(self, places: np.ndarray) -> None:
        np.bitwise_or.at(self.bits, (places >> np.uint64(3)).ravel(), (1 << (places & np.uint64(7)).ravel()).astype(np.uint8))

    def holds(self, places: np.ndarray) -> np.ndarray:
        return (self.bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8) & 1).all(axis=1)


def packed(page: np.ndarray) -> bytes:
    """A page as its bit numbers (two bytes each) while that is smaller than the page itself."""
    places = np.flatnonzero(np.unpackbits(page, bitorder="little")).astype("<u2")
    return places.tobytes() if len(places) < PAGE // 16 else page.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if len(data) == PAGE // 8:
        return np.frombuffer(data, np.uint8)
    bits = np.zeros(PAGE, np.uint8)
    bits[np.frombuffer(data, "<u2")] = 1
    return np.packbits(bits, bitorder="little")


def _fill(pages: int, shortest: int):
    def run(batches):
        once, twice = Filter(pages), Filter(pages)
        for batch in batches:
            hashes = key_hashes(k for text in batch.column(0).to_pylist() for k in line_keys(text, shortest))
            if not len(hashes):
                continue
            hashes, times = np.unique(hashes, return_counts=True)
            places = once.places(hashes)
            twice.add(places[(times > 1) | once.holds(places)])
            once.add(places)
        rows = once.bits.reshape(pages, -1), twice.bits.reshape(pages, -1)
        touched = np.flatnonzero(rows[0].any(axis=1))
        for at in range(0, len(touched), 256):
            some = touched[at:at + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array([packed(rows[0][p]) for p in some], pa.binary()),
                 pa.array([packed(rows[1][p]) for p in some], pa.binary())], schema=SENT)
    return run


def _merge(batches):
    """Pages sorted by number -> one row a page: what was seen twice."""
    page, once, twice = None, None, None

    def ended():
        return pa.RecordBatch.from_arrays([pa.array([page], pa.int32()), pa.array([packed(twice)], pa.binary())],
                                          names=["page", "twice"])

    for batch in batches:
        for number, seen, again in zip(*(c.to_pylist() for c in batch.columns)):
            if number != page:
                if page is not None and twice.any():
                    yield ended()
                page, once, twice = number, np.zeros(PAGE // 8, np.uint8), np.zeros(PAGE // 8, np.uint8)
            seen = unpacked(seen)
            twice |= unpacked(again) | once & seen
            once |= seen
    if page is not None and twice.any():
        yield ended()


def seen_twice(texts: DataFrame, shortest: int, filter_bytes: int = FILTER_BYTES) -> Filter:
    """The filter of keys that at least two rows of ``texts`` (one column) hold, and of others by chance."""
    room = max(1, min(filter_bytes * 8 // PAGE, text_bytes(texts, texts.columns[0]) // 8 * HASHES // PAGE))
    pages = 1 << (room.bit_length() - 1)
    sent = texts.mapInArrow(_fill(pages, shortest), "page int, once binary, twice binary")
    merged = sent.repartition("page").sortWithinPartitions("page").mapInArrow(_merge, "page int, twice binary")
    found = Filter(pages)
    by_page = found.bits.reshape(pages, -1)
    for row in merged.collect():  # filter_bytes at most
        by_page[row["page"]] = unpacked(bytes(row["twice"]))
    return found


def suspects(rows: DataFrame, twice: Filter, shortest: int) -> DataFrame:
    """(doc_id, version, key, lines) of every key in the filter, a row for each key of a document."""
    held = rows.sparkSession.sparkContext.broadcast(twice.bits)
    pages = twice.pages

    def run(batches):
        known = Filter(pages, held.value)
        for batch in batches:
            ids, versions, texts = (c.to_pylist() for c in batch.columns)
            own = [(i, v, k, at) for i, v, t in zip(ids, versions, texts) for k, at in line_keys(t, shortest).items()]
            if own:
                hit = known.holds(known.places(key_hashes(x[2] for x in own)))
                own = [x for x, yes in zip(own, hit) if yes]
            for at in range(0, len(own), 4096):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*own[at:at + 4096]), SUSPECT)], schema=SUSPECT)
    return rows.select("doc_id", "version", "text").mapInArrow(run, SUSPECT_DDL)


def _without(batches):
    for batch in batches:
        ids, texts, drops = (batch.column(c).to_pylist() for c in ("doc_id", "text", "drops"))
        out = []
        for i, text, gone in zip(ids, texts, drops):
            lines = (text or "").split("\n")
            gone = set(gone or ())
            out.append((i, "\n".join(x for at, x in enumerate(lines) if at not in gone) if gone else text or "",
                        len(lines), len(gone)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.int64(), pa.int64()))],
            names=["doc_id", "text", "n_lines", "n_dropped"])


def dedup_lines(docs: DataFrame, shortest: int = 40, least_docs: int = 5, id_col: str = "doc_id",
                text_col: str = "text", filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped), one row per row of ``docs``: the text without the lines that other documents
    keep, the number of lines before, and how many were left out."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")) \
        .withColumn("version", F.xxhash64("text"))
    found = materialize(suspects(rows, seen_twice(rows.select("text"), shortest, filter_bytes), shortest),
                        "line-suspects")
    document = F.struct("doc_id", F.when(F.col("doc_id").isNull(), F.col("version")).alias("version"))
    found = found.withColumn("document", document)
    shared = materialize(found.select("key", "document").distinct().groupBy("key")
                         .agg(F.count(F.lit(1)).alias("n"), F.max("document").alias("last"))
                         .where(F.col("n") >= least_docs), "line-shared")  # a table, so that a frequent key's join is split
    gone = found.join(shared, "key").where(~F.col("document").eqNullSafe(F.col("last")))
    drops = gone.groupBy("doc_id", "version").agg(F.flatten(F.collect_list("lines")).alias("drops")) \
        .withColumnsRenamed({"doc_id": "drop_id", "version": "drop_version"})
    joined = rows.join(drops, rows["doc_id"].eqNullSafe(drops["drop_id"])
                       & (rows["version"] == drops["drop_version"]), "left").select("doc_id", "text", "drops")
    return joined.mapInArrow(_without, "doc_id long, text string, n_lines long, n_dropped long")


ORACLE = """
WITH line AS (
  SELECT doc_id, pos, s, translate(trim(s, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(a) AS s, unnest(range(1, len(a) + 1)) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents))),
shared AS (SELECT key, max(doc_id) AS last FROM line WHERE length(key) >= 40
           GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT line.doc_id, pos, s, coalesce(last <> line.doc_id, false) AS gone FROM line LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(s, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
