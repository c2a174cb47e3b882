"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts. After a context, the escape probability goes to the context one byte shorter,
whose distribution is taken without the symbols seen here (symbol exclusion); the rest is shared by the symbols seen,
by their counts; below the empty context all bytes are equal. How likely an escape is, is estimated by leaving each
training occurrence out in turn, over nodes alike. The code length of a text adds up over the bytes of its
lower-cased words, single spaces between them and one end, started after an end.

Every context and symbol of the whole training text counts, at every order, without a capacity. A task cuts the rows
it reads into blocks of about ``BLOCK_BYTES`` of text, so no key decides where a row goes. A block's distinct grams
(ORDER context bytes and the byte behind) are dealt to shards by their last three context bytes, packed as one row per
block and shard, with their training occurrences. A shard then holds the suffixes, of three bytes and more, of all its
contexts: it adds up the blocks' counts, works out the cost of its grams by itself, from the order below up, and sends
every block the costs of the block's grams, in the order in which the block dealt them; the block finds that order again
from its texts. Only what is of bounded size goes through the driver: contexts of up to two bytes, and per order the
escapes seen by state.

The unigram base counts every word of the training rows in the same way: a block deals its distinct words to shards by
hash, a shard adds up the counts and sends the block those of its words, so the vocabulary is neither collected nor
broadcast and a frequent word is one entry a block.

Null and empty texts are the single end. A null id counts as training. Repeated rows count and are scored as often as
they occur; other columns are not read. Texts of any length are read whole. Without training rows the counts are 0.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.llm.common import arrow_rows, lower_words, materialize, parts, text_bytes

ORDER, LOW, BLOCK_BYTES, SHARD_BYTES, CHUNK, MERGE = 6, 2, 14 << 20, 16 << 20, 1 << 20, 8 << 20
PRIOR = 20.0  # occurrences that the plain escape estimate counts for
END = 10  # the byte of an end; no word holds it
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")
_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                     ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                     ("score", pa.float64())])
#: A piece of a block: of its grams (kind 0) or words (kind 1), the shard's share with training counts; of its texts
#: (kind 2), some rows.
PIECES = "block long, kind int, shard int, size long, keys binary, ns binary"
_PIECES = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("shard", pa.int32()), ("size", pa.int64()),
                     ("keys", pa.binary()), ("ns", pa.binary())])
#: What a shard sends back to a block: a value for each key of its piece; one row of a word shard has its sums.
BACK = "block long, kind int, shard int, size long, keys binary, tokens long, vocabulary long"


def stream(words: list[bytes]) -> bytes:
    """What the byte model reads of a text: an end in front as context, its words, its own end."""
    return b"\n" * ORDER + b" ".join(words) + b"\n"


def grams(raw: np.ndarray) -> np.ndarray:
    """ORDER context bytes and the byte behind them, as one number per position."""
    n = len(raw) - ORDER
    out = np.zeros(n, np.int64)
    for k in range(ORDER + 1):
        out = out << 8 | raw[k:k + n]
    return out


def tally(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams in order, and the sum of ``n`` over each."""
    key, at = np.unique(gram, return_inverse=True)
    return key, np.bincount(at, weights=n, minlength=len(key)).astype(np.int64)


def rows_blob(rows: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as to:
        to.write_batch(rows)
    return out.getvalue().to_pybytes()


def blob_rows(blob: bytes):
    with pa.ipc.open_stream(blob) as got:
        for batch in got:
            yield from zip(*(c.to_pylist() for c in batch.columns))


def block_grams(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of some streams and how often each occurs, in pieces of bounded size."""
    gram, n, held, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def merged():
        more, m = np.unique(np.concatenate(held), return_counts=True)
        return tally(np.concatenate([gram, more]), np.concatenate([n, m]))

    for raw in texts:
        for at in range(0, len(raw) - ORDER, CHUNK):
            held.append(grams(raw[at:at + CHUNK + ORDER]))
            size += len(held[-1])
            if size >= MERGE:
                gram, n = merged()
                held, size = [], 0
    return merged() if held else (gram, n)


def state(total: np.ndarray, types: np.ndarray) -> np.ndarray:
    """Nodes alike: about that many occurrences (quarter powers of two), that many symbols."""
    return (np.log2(total) * 4).astype(np.int64) * 64 + np.minimum(types, 63)


STATES = 64 * 4 * 64


def speak(at: np.ndarray, n: np.ndarray, total: np.ndarray, types: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per state, the occurrences left out that were escapes, and all of them."""
    rest = total[at] - 1
    ok = rest > 0
    key = state(np.maximum(rest, 1), types[at] - (n == 1))[ok]
    return (np.bincount(key, weights=((n == 1) * n)[ok], minlength=STATES),
            np.bincount(key, weights=n[ok], minlength=STATES))


def escapes(at: np.ndarray, n: np.ndarray, total: np.ndarray, types: np.ndarray) -> np.ndarray:
    """Escape probability of every node, learned from nodes alike.

    Each occurrence is left out in turn (``speak``): the node then has one occurrence less, and one symbol less if it
    was the symbol's only one, which would have been an escape. The share of escapes is taken over all nodes of the order
    that have about that many occurrences (quarter powers of two) and that many symbols, drawn towards
    types / (total + types) where few speak.
    """
    return drawn(*speak(at, n, total, types), total, types)


def drawn(novel: np.ndarray, every: np.ndarray, total: np.ndarray, types: np.ndarray) -> np.ndarray:
    """Escape probability of nodes from what the states of their order say."""
    mine = state(total, types)
    return (novel[mine] + PRIOR * (types / (total + types))) / (every[mine] + PRIOR)


class Trie:
    """log10 probabilities of every byte after every node of the orders given.

    Tables have a column per byte that occurs in training and one that stands for each of the others.
    """

    def __init__(self, levels):
        seen = np.unique(levels[0][1])
        other = np.setdiff1d(np.arange(256), seen)
        wide = len(seen) + 1  # columns; the last one is any other byte
        self.column = np.full(256, len(seen), np.int32)
        self.column[seen] = np.arange(len(seen))
        stands = np.r_[np.ones(len(seen)), len(other)]
        table, rows_of, base = [np.full((1, wide), 1 / 256)], [], 1
        for context, symbol, n in levels:
            nodes, at = np.unique(context, return_inverse=True)
            count = np.zeros((len(nodes), wide))
            count[at, self.column[symbol]] = n
            types, total = (count > 0).sum(1), count.sum(1)
            lower = np.concatenate(table)[self._rows(rows_of, nodes)]
            lower[count > 0] = 0  # symbol exclusion
            rest = lower @ stands
            escape = np.where(rest > 0, escapes(at, n, total, types), 0)
            table.append(count * ((1 - escape) / total)[:, None] + lower * (escape / np.where(rest > 0, rest, 1))[:, None])
            rows_of.append((nodes, base))
            base += len(nodes)
        with np.errstate(divide="ignore"):
            self.cost = np.log10(np.concatenate(table))
        self.rows_of = rows_of

    def probability(self, gram: np.ndarray) -> np.ndarray:
        """Of the last byte of every gram after the longest node that ends its context."""
        return 10.0 ** self.cost[self._rows(self.rows_of, gram >> 8), self.column[gram & 255]]

    @staticmethod
    def _rows(rows_of, context: np.ndarray) -> np.ndarray:
        """Row of the longest node that ends each context, among the orders given."""
        out = np.zeros(len(context), np.int64)
        for order, (nodes, base) in enumerate(rows_of):
            if len(nodes):
                short = context & ((1 << 8 * order) - 1)
                at = np.minimum(np.searchsorted(nodes, short), len(nodes) - 1)
                out = np.where(nodes[at] == short, base + at, out)
        return out


class Level:
    """The contexts of one order in a shard: (context, symbol) keys in order, and their contexts."""

    def __init__(self, gram: np.ndarray, n: np.ndarray, order: int):
        self.mask = (1 << 8 * (order + 1)) - 1
        self.key, self.n = tally(gram & self.mask, n)
        self.context, self.at = np.unique(self.key >> 8, return_inverse=True)
        self.types = np.bincount(self.at, minlength=len(self.context))
        self.total = np.bincount(self.at, weights=self.n, minlength=len(self.context)).astype(np.int64)


def shard_levels(gram: np.ndarray, n: np.ndarray) -> list[Level]:
    """Levels of the orders above LOW, of the grams that occur in training."""
    out = []
    for order in range(ORDER, LOW, -1):
        out.append(Level(gram, n, order))
        gram, n = out[-1].key, out[-1].n
    return out[::-1]


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def gram_costs(gram: np.ndarray, n: np.ndarray, low: Trie, spoken: dict) -> np.ndarray:
    """log10 probability of every gram of a shard; ``n`` is 0 for grams that do not occur in training."""
    out = low.probability(gram)
    if not n.any():
        return np.log10(out)
    below = None
    for order, level in enumerate(shard_levels(gram[n > 0], n[n > 0]), LOW + 1):
        if below is None:
            under = low.probability(level.key)
        else:
            under = p[_find(below.key, level.key & below.mask)[0]]  # every suffix is a node
        escape = np.where(level.types < 256, drawn(*spoken[order], level.total, level.types), 0)
        rest = np.maximum(1 - np.bincount(level.at, weights=under, minlength=len(level.context)), 1e-12)
        p = level.n / level.total[level.at] * (1 - escape[level.at])
        node, known = _find(level.context, gram >> 8 & level.mask >> 8)
        entry, seen = _find(level.key, gram & level.mask)
        out = np.where(seen, p[entry], np.where(known, out * (escape / rest)[node], out))
        below = level
    return np.log10(out)


def pack(values: np.ndarray) -> bytes:
    """Numbers as all their first bytes, all their second ones and so on, compressed."""
    raw = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return pa.compress(raw.tobytes(), codec="zstd", asbytes=True)


def unpack(packed: bytes, size: int, kind) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(packed, size * wide, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(wide, size).T).view(kind).ravel()


def unpack_grams(packed: bytes, size: int) -> np.ndarray:
    return np.cumsum(unpack(packed, size, np.int64))


def dealt(gram: np.ndarray, shards: int) -> list[tuple[int, np.ndarray]]:
    """(shard, places) of distinct grams in order, by the last three bytes of their contexts."""
    suffix = gram >> 8 & (1 << 8 * (LOW + 1)) - 1
    shard = (suffix * 2654435761 >> 8 & 0xffffff) % shards
    order = np.argsort(shard, kind="stable")
    ends = np.searchsorted(shard[order], np.arange(shards + 1))
    return [(k, order[a:b]) for k, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]


def dealt_words(words, shards: int) -> list[tuple[int, list[bytes]]]:
    """(shard, words in order) of distinct words."""
    out: dict[int, list[bytes]] = {}
    for word in sorted(words):
        out.setdefault(zlib.crc32(word) % shards, []).append(word)
    return sorted(out.items())


def zipped(raw: bytes) -> bytes:
    """Compressed, behind its length."""
    return len(raw).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unzipped(packed: bytes) -> bytes:
    return pa.decompress(packed[4:], int.from_bytes(packed[:4], "little"), codec="zstd", asbytes=True)


class Block:
    """Some rows (doc_id, text, held_out) with their distinct grams and words; made alike whenever it is read."""

    def __init__(self, rows):
        self.rows, self.streams = rows, []
        self.place = defaultdict(count().__next__)  # of every word, in the order in which they are met
        self.tokens = []  # the places of a row's words
        for _, text, _ in rows:
            tokens = lower_words(text)
            self.streams.append(np.frombuffer(stream(tokens), np.uint8))
            tokens.append(b"")
            self.tokens.append(np.fromiter(map(self.place.__getitem__, tokens), np.int32, len(tokens)))

    def places(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def known(self) -> np.ndarray:
        """Occurrences of every word in training rows, by place."""
        out = np.zeros(len(self.place), np.int64)
        for at, row in zip(self.tokens, self.rows):
            if not row[2]:
                np.add.at(out, at, 1)
        return out

    def distinct(self) -> np.ndarray:
        """The distinct grams of all rows, in order."""
        return block_grams(self.streams)[0]

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """The same with their occurrences in training rows."""
        gram, n = block_grams([x for x, row in zip(self.streams, self.rows) if not row[2]])
        only = np.setdiff1d(block_grams([x for x, row in zip(self.streams, self.rows) if row[2]])[0], gram, assume_unique=True)
        order = np.argsort(gram := np.concatenate([gram, only]), kind="stable")  # two runs in order: a merge
        return gram[order], np.concatenate([n, np.zeros(len(only), np.int64)])[order]


def cut(batches_, shards: int):
    """Rows -> pieces of blocks of about BLOCK_BYTES of text each."""
    at = TaskContext.get().partitionId() << 32

    def pieces(rows):
        block = Block(rows)
        gram, n = block.counted()
        out = [(at, 0, k, len(x), pack(np.diff(gram[x], prepend=0)), pack(n[x])) for k, x in dealt(gram, shards)]
        known = block.known()
        out += [(at, 1, k, len(x), zipped(b"\n".join(x)), pack(known[block.places(x)]))
                for k, x in dealt_words(block.place, shards)]
        sizes = np.cumsum([len(r[1] or "") for r in rows]) >> 18  # text rows of about 256 k characters
        for part in np.unique(sizes):
            some = [rows[k] for k in np.flatnonzero(sizes == part)]
            out.append((at, 2, int(part), len(some), rows_blob(arrow_rows(some, _ROWS)), None))
        for k in range(0, len(out), 16):
            yield arrow_rows(out[k:k + 16], _PIECES)

    held, size = [], 0
    for batch in batches_:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            held.append(row)
            size += len(row[1] or "")
            if size >= BLOCK_BYTES:
                yield from pieces(held)
                held, size, at = [], 0, at + 1
    if held:
        yield from pieces(held)


_ROWS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("held_out", pa.bool_())])


def word_counts(found: pa.Table) -> pa.Table:
    """A shard's pieces of words -> the words' counts over all blocks, for each piece; its sums once."""
    total: Counter = Counter()
    pieces = [*zip(*(found.column(c).to_pylist() for c in ("block", "shard", "size", "keys", "ns")))]
    for _, _, size, keys, ns in pieces:
        for word, n in zip(unzipped(keys).split(b"\n"), unpack(ns, size, np.int64).tolist()):
            if n:
                total[word] += n
    out = [(block, 1, shard, size, pack(np.array([total[w] for w in unzipped(keys).split(b"\n")], np.int64)), 0, 0)
           for block, shard, size, keys, _ in pieces]
    if out:
        out[0] = (*out[0][:5], sum(total.values()), len(total))
    return arrow_table(out)


def arrow_table(rows) -> pa.Table:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
    names = ("block", "kind", "shard", "size", "keys", "tokens", "vocabulary")
    return pa.Table.from_batches([arrow_rows(rows, pa.schema([*zip(names, kinds)]))])


def shard_counts(found: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(gram, n) of a shard, added up over blocks."""
    gram, n, held, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0
    for k, (length, g, c) in enumerate(zip(*(found.column(c).to_pylist() for c in ("size", "keys", "ns"))), 1):
        held.append((unpack_grams(g, length), unpack(c, length, np.int64)))
        size += length
        if size >= CHUNK or k == found.num_rows:
            gram, n = tally(np.concatenate([gram, *(h[0] for h in held)]), np.concatenate([n, *(h[1] for h in held)]))
            held, size = [], 0
    return gram, n


def by_shard(inside: DataFrame) -> DataFrame:
    """The costs of the blocks' grams (pieces of kind 0), as ``BACK``."""
    spark = inside.sparkSession

    def statistics(found):
        gram, n = shard_counts(found)
        gram, n = gram[n > 0], n[n > 0]
        level, key, a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0)]
        for order, got in enumerate(shard_levels(gram, n) if len(gram) else [], LOW + 1):
            novel, every = speak(got.at, got.n, got.total, got.types)
            said = np.flatnonzero(every)
            level.append(np.full(len(said), order))
            key.append(said)
            a.append(novel[said])
            b.append(every[said])
        short, m = tally(gram & ((1 << 8 * (LOW + 1)) - 1), n)  # contexts of up to two bytes
        level.append(np.full(len(short), LOW))
        key.append(short)
        a.append(np.zeros(len(short)))
        b.append(m.astype(float))
        return pa.table([np.concatenate(x) for x in (level, key, a, b)], names=["level", "key", "a", "b"])

    # at most STATES rows an order, and the symbols behind two bytes
    got = inside.groupBy("shard").applyInArrow(statistics, "level long, key long, a double, b double") \
        .groupBy("level", "key").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toPandas()
    spoken = {order: (np.zeros(STATES), np.zeros(STATES)) for order in range(LOW + 1, ORDER + 1)}
    for order, (novel, every) in spoken.items():
        mine = got[got["level"] == order]
        novel[mine["key"]], every[mine["key"]] = mine["a"], mine["b"]
    mine, levels = got[got["level"] == LOW], []
    for order in range(LOW, -1, -1):
        key, n = tally(mine["key"].to_numpy(np.int64) & ((1 << 8 * (order + 1)) - 1), mine["b"].to_numpy())
        levels.append((key >> 8, key & 255, n))
    sent = spark.sparkContext.broadcast((levels[::-1], spoken))

    def costs(found):
        gram, n = shard_counts(found)
        levels, spoken = sent.value
        cost = gram_costs(gram, n, Trie(levels), spoken).astype(np.float32)
        return arrow_table([(block, 0, shard, size, pack(cost[_find(gram, unpack_grams(keys, size))[0]]), 0, 0)
                            for block, shard, size, keys in zip(*(found.column(c).to_pylist() for c in ("block", "shard", "size", "keys")))])

    return inside.groupBy("shard").applyInArrow(costs, BACK)


def stream_costs(streams: list[np.ndarray], known: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """log10 probability of every stream, from the cost of its grams; ``known`` is in order."""
    out = np.zeros(len(streams))
    held, docs, size = [], [], 0

    def flush():
        gram, doc = np.concatenate(held), np.repeat(docs, [len(g) for g in held])
        order = np.argsort(gram)
        gram = gram[order]
        new = np.r_[True, gram[1:] != gram[:-1]]
        at, found = _find(known, gram[new])
        if not found.all():
            raise ValueError("a gram of the block has no cost")
        out[:] += np.bincount(doc[order], weights=cost[at][np.cumsum(new) - 1], minlength=len(out))

    for doc, raw in enumerate(streams):
        for at in range(0, len(raw) - ORDER, CHUNK):
            held.append(grams(raw[at:at + CHUNK + ORDER]))
            docs.append(doc)
            size += len(held[-1])
            if size >= CHUNK:
                flush()
                held, docs, size = [], [], 0
    if held:
        flush()
    return out


def score(docs: DataFrame, modulus: int = 7, held: int = 2, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    size = text_bytes(docs, text_col)
    shards = parts(size, SHARD_BYTES)
    crc = F.crc32(F.coalesce(docs[id_col].cast("string"), F.lit("")))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"),
                       (F.pmod(crc, F.lit(modulus)) == held).alias("held_out"))
    pieces = materialize(rows.mapInArrow(lambda found: cut(found, shards), PIECES), "ppm-blocks")
    costs = by_shard(pieces.where("kind = 0"))
    words = materialize(pieces.where("kind = 1").groupBy("shard").applyInArrow(word_counts, BACK), "ppm-words")
    sums = words.agg(F.sum("tokens").alias("n"), F.sum("vocabulary").alias("v")).first()
    total, vocabulary = int(sums["n"] or 0), int(sums["v"] or 0)

    def scored(found):
        kinds = found.column("kind").to_pylist()
        blobs, back = {}, ({}, {})
        for kind, shard, length, keys in zip(kinds, *(found.column(c).to_pylist() for c in ("shard", "size", "keys"))):
            if kind == 2:
                blobs[shard] = keys
            else:
                back[kind][shard] = unpack(keys, length, np.int64 if kind else np.float32)
        block = Block([row for k in sorted(blobs) for row in blob_rows(blobs[k])])
        gram = block.distinct()
        cost = np.empty(len(gram), np.float32)
        for shard, at in dealt(gram, shards):
            cost[at] = back[0][shard]
        value = np.empty(len(block.place))
        for shard, own in dealt_words(block.place, shards):
            value[block.places(own)] = np.log10(back[1][shard] + 1.0)
        unit = math.log10(total + vocabulary + 1)
        out = []
        for (doc, _, held_out), tokens in zip(block.rows, block.tokens):
            got = value[tokens]
            out.append((doc, held_out, len(tokens), int((got > 0).sum()), total,
                        float(got.sum()) - len(tokens) * unit))
        columns = [*zip(*out), stream_costs(block.streams, gram, cost)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCORES)], schema=_SCORES)

    parts_of = ["block", "kind", "shard", "size", "keys"]
    return pieces.where("kind = 2").select(*parts_of).unionByName(words.select(*parts_of)).unionByName(costs.select(*parts_of)) \
        .groupBy("block").applyInArrow(scored, SCORES)
