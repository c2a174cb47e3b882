"""Near-duplicate documents by an inverted join over signature coordinates.

Every distinct shingle set gets a MinHash signature of ``coordinates`` values. A set is posted under each
(coordinate, value) pair. Two sets at the required similarity agree in a known number of coordinates, so pairs with
fewer than ``matches`` common postings are never looked at: ``matches`` is the largest count that misses a pair at
the threshold with probability below ``miss``.

* Skip: postings that only one set has cannot produce a pair, and a set with fewer than ``matches`` shared
  postings has no partner; both leave before any join.
* Prefix: of a set's m shared postings, ordered from rare to common, a partner with ``matches`` common ones must
  share one of the first m - matches + 1. Only these meet in the join, so frequent values rarely do.

Groups of copies would meet in pairs, so pairs are formed only where nothing else decides:

1. Equal sets are one set. Every posting names ``LEADERS`` of its members, by hash; a set's collisions with its leaders
   are merged by counting, and it is held against the one it meets most often under each hash. Pairs with ``matches``
   collisions are *near*; those that full sets confirm are links. A row per set and hash, whatever the group's size.
2. Near sets are grouped in a few rounds of labels; sets of different labels meet in the prefix join, sets of other
   sizes excepted. That completes the near groups: two sets with ``matches`` collisions are in one group.
3. Inside a near group the largest class of linked sets needs nothing; the sets outside it are held against the whole
   group on full sets, block against block of bounded size. A block pair gives only links that join classes.

So no link between different texts is lost, and no group is expanded into its pairs. Frequent values are split by
adaptive execution in plain equi joins with stored tables on both sides.

A null text and a text without words have an empty set and are linked with nothing. Repeated rows, ids given twice
and null ids are kept: results belong to the row's set, and the smallest id ignores nulls (a class without any id has
a null component). Other columns are not read. Texts of any length are shingled whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.llm.common import components, joined_components, lower_words, materialize

_SETS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.int64()),
                   ("signature", pa.list_(pa.int64())), ("text_hash", pa.int64())])
SETS = "doc_id long, n_shingles long, set_id long, signature array<long>, text_hash long"
BROADCAST = 2_000_000  # rows of two longs
LEADERS = 6
BLOCK_SETS, BLOCK_SHINGLES = 1024, 1_500_000  # of one side of a block pair


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; fewer words than that are one shingle."""
    tokens = lower_words(text)
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(tokens))], np.uint64)
    ones = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    n = len(ones) - words + 1
    mixed = ones[:n].copy()
    for k in range(1, words):  # an ordered mix of the words' hashes
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) + ones[k:k + n]
    mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0x94D049BB133111EB)
    return np.unique(mixed ^ mixed >> np.uint64(29))


def set_id(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def families(coordinates: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return (rng.integers(1, 1 << 62, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, coordinates, dtype=np.uint64))


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 512) -> np.ndarray:
    """Least value of every hash family over a set; a few hundred shingles at a time, all families at once."""
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), block):
        grid = np.multiply.outer(a, hashes[at:at + block])
        grid += b[:, None]
        np.minimum(low, grid.min(axis=1), out=low)
    return low


def _signed(signatures: list[np.ndarray | None]) -> pa.ListArray:
    """Signatures (None for empty sets) as a list column, without a Python object per value."""
    there = np.array([s is not None for s in signatures], bool)
    ends = np.cumsum([0] + [0 if s is None else len(s) for s in signatures]).astype(np.int32)
    values = [s.view(np.int64) for s in signatures if s is not None]
    return pa.ListArray.from_arrays(pa.array(ends, mask=np.append(~there, False)),
                                    pa.array(np.concatenate(values) if values else np.empty(0, np.int64)))


def least_matches(coordinates: int, share: float, miss: float) -> int:
    """Largest count t for which fewer than t agreements of ``coordinates`` have probability < ``miss``."""
    total, t = 0.0, 0
    while True:
        total += math.comb(coordinates, t) * share ** t * (1 - share) ** (coordinates - t)
        if total >= miss:
            return max(1, t)
        t += 1


def sets_of(docs: DataFrame, words: int, coordinates: int) -> DataFrame:
    """(doc_id, n_shingles, set_id, signature) of every row; empty sets have neither set_id nor signature."""
    a, b = families(coordinates)

    def run(found):
        for batch in found:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes, numbers, signatures = [], [], []
                for text in part.column(1).to_pylist():
                    h = shingle_hashes(text, words)
                    sizes.append(len(h))
                    numbers.append(set_id(h) if len(h) else None)
                    signatures.append(signature(h, a, b) if len(h) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()),
                                                  pa.array(numbers, pa.int64()), _signed(signatures), part.column(2)],
                                                 schema=_SETS)

    return docs.select("doc_id", "text", F.xxhash64("text")).mapInArrow(run, SETS)


def _full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(set_id, hashes): the whole shingle sets of ``wanted`` (set_id, first_id, text_hash), from the texts that carry
    that id and hash, so texts without an id do not all meet; repeated rows give one set."""

    def run(found):
        for batch in found:
            ids, sets = [], []
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = shingle_hashes(text, words)
                if len(h) and set_id(h) == number:  # a hash may be carried by another text as well
                    ids.append(number)
                    sets.append(h.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())],
                                             names=["set_id", "hashes"])

    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST else wanted
    same = docs["doc_id"].eqNullSafe(wanted["first_id"]) & (F.xxhash64(docs["text"]) == wanted["text_hash"])
    return docs.join(wanted, same).select("set_id", "text").mapInArrow(run, "set_id long, hashes binary") \
        .groupBy("set_id").agg(F.first("hashes").alias("hashes"))


def _confirm(pairs: DataFrame, own: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets intersect in at least ``percent`` hundredths of their union."""
    pairs = materialize(pairs, "minhash-pairs")
    both = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    sets = _full_sets(docs, materialize(own.select("set_id", "first_id", "text_hash").join(both, "set_id"), "minhash-wanted"), words)
    side = lambda name: sets.select(F.col("set_id").alias(name), F.col("hashes").alias(f"{name}_hashes"))

    def run(found):
        for batch in found:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                if 100 * len(small) < percent * len(large):
                    keep.append(False)
                    continue
                at = np.searchsorted(large, small)
                common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_hashes", "b_hashes") \
        .mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, coordinates: int = 40, miss: float = 1e-5,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash, first) of every row. ``kept``: the row has its class's
    smallest id. ``first``: it also has the text that represents the class (of several texts under that id, or of a
    class without any id, the one of least hash); rows without words are first, each for itself."""
    matches = least_matches(coordinates, percent / 100, miss)
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    rows = materialize(sets_of(docs, words, coordinates), "minhash-rows")
    own = materialize(rows.where("set_id is not null").groupBy("set_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash")).alias("least"),
        F.first("signature").alias("signature"), F.first("n_shingles").alias("size"))
        .select("set_id", F.col("least.doc_id").alias("first_id"), "least.text_hash", "signature", "size"), "minhash-sets")
    posted = own.select("set_id", "size", F.posexplode("signature").alias("coordinate", "value")) \
        .select("set_id", "size", F.xxhash64("coordinate", "value").alias("posting"))
    shared = materialize(posted.groupBy("posting").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "minhash-shared")
    # skip: shared postings only, and only of sets that have enough of them; rare ones first
    counted = materialize(posted.join(shared, "posting").groupBy("set_id", "size")
                          .agg(F.sort_array(F.collect_list(F.struct("n", "posting"))).alias("p"))
                          .where(F.size("p") >= matches)
                          .select("set_id", "size", F.col("p.posting").alias("postings")), "minhash-postings")
    near = materialize(_enough(_led(counted, percent), counted, matches), "minhash-near")
    links = materialize(_confirm(near, own, docs, words, percent), "minhash-links")
    groups = _near_groups(counted, near, matches, percent)
    # some rounds: classes that are too fine only ask more of the blocks, which join them
    classes = components(links, "minhash-classes", rounds=2)
    sets = materialize(groups.join(classes.withColumnsRenamed({"node": "set_id", "component": "class"}), "set_id", "left")
                       .select("set_id", "size", "near", F.coalesce("class", "set_id").alias("class")), "minhash-classed")
    more = materialize(_inside(sets, own, docs, words, percent), "minhash-block-links")
    found = joined_components(sets.select(F.col("set_id").alias("node"), F.col("class").alias("label")),
                              links.union(more), "minhash-components")
    label = materialize(own.select("set_id", F.struct(F.col("first_id").isNull().alias("without"), "first_id", "text_hash").alias("own"))
                        .join(found.withColumnRenamed("node", "set_id"), "set_id", "left")
                        .select("set_id", "own", F.coalesce("component", "set_id").alias("class")), "minhash-labels")
    least = label.groupBy("class").agg(F.min("own").alias("least"))
    by_set = label.join(least, "class").select("set_id", "least")
    out = rows.join(by_set, "set_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least.first_id")).otherwise(F.col("doc_id"))
    first = F.col("doc_id").eqNullSafe(F.col("least.first_id")) & (F.col("text_hash") == F.col("least.text_hash"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"), "text_hash",
                      ((F.col("n_shingles") == 0) | F.coalesce(first, F.lit(False))).alias("first"))


def _fits(a, b, percent: int):
    """Whether sets of these sizes can be similar enough."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _led(counted: DataFrame, percent: int) -> DataFrame:
    """(a, b): every set b with, for each of ``LEADERS`` hashes, the leader a that it meets in most postings."""
    postings = counted.select("set_id", "size", F.explode("postings").alias("posting"))
    first = [F.min(F.struct(F.xxhash64("set_id", F.lit(k)).alias("h"), "set_id", "size")).alias(f"l{k}") for k in range(LEADERS)]
    leaders = materialize(postings.groupBy("posting").agg(*first).select("posting", F.array(*[
        F.struct(F.lit(k).alias("k"), F.col(f"l{k}.set_id").alias("a"), F.col(f"l{k}.size").alias("a_size"))
        for k in range(LEADERS)]).alias("leaders")), "minhash-leaders")
    met = postings.join(leaders, "posting").select(F.col("set_id").alias("b"), F.explode(F.filter(
        "leaders", lambda x: (x["a"] != F.col("set_id")) & _fits(x["a_size"], F.col("size"), percent))).alias("l")) \
        .groupBy("b", "l.k", "l.a").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return met.groupBy("b", "k").agg(F.max(F.struct("n", "a")).alias("m")).select("m.a", "b").distinct()


def _near_groups(counted: DataFrame, near: DataFrame, matches: int, percent: int) -> DataFrame:
    """(set_id, size, near): sets with ``matches`` collisions, directly or over others, have the same ``near``."""
    first = components(near.select("a", "b"), "minhash-groups", rounds=3).withColumnsRenamed({"node": "set_id", "component": "near"})
    named = materialize(counted.join(first, "set_id", "left").select(
        "set_id", "size", "postings", F.coalesce("near", "set_id").alias("near")), "minhash-named")
    prefix = materialize(named.select("set_id", "size", "near", F.explode(
        F.slice("postings", 1, F.size("postings") - (matches - 1))).alias("posting")), "minhash-prefixes")
    mixed = prefix.groupBy("posting").agg(F.min("near").alias("lo"), F.max("near").alias("hi")).where("lo < hi").select("posting")
    open_ = materialize(prefix.join(mixed, "posting", "left_semi"), "minhash-open")
    left, right = (open_.select("posting", F.col("set_id").alias(x), F.col("near").alias(f"near_{x}"),
                                F.col("size").alias(f"size_{x}")) for x in "ab")
    pairs = left.join(right, "posting").where(F.col("a") < F.col("b")) \
        .where(F.col("near_a") != F.col("near_b")).where(_fits(F.col("size_a"), F.col("size_b"), percent)) \
        .select("a", "b").distinct()
    met = _enough(pairs, counted, matches).select("a", "b")
    groups = joined_components(named.select(F.col("set_id").alias("node"), F.col("near").alias("label")),
                               near.select("a", "b").union(met), "minhash-joined-groups")
    return named.select("set_id", "size").join(groups.withColumnsRenamed({"node": "set_id", "component": "near"}), "set_id")


def _inside(sets: DataFrame, own: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links that join classes inside near groups (set_id, size, near, class), found on full sets."""
    bulk = sets.groupBy("near", "class").agg(F.count(F.lit(1)).alias("n")).groupBy("near") \
        .agg(F.max(F.struct("n", "class")).alias("m"), F.count(F.lit(1)).alias("classes")).where("classes > 1") \
        .select("near", F.col("m.class").alias("bulk"))
    ratio = F.lit(101 / percent)  # a little more than sizes of linked sets can differ by
    members = materialize(sets.join(bulk, "near").select(
        "set_id", "size", "near", "class", (F.col("class") != F.col("bulk")).alias("query"),
        F.floor(F.log("size") / F.log(ratio)).cast("int").alias("range")), "minhash-members")
    full = _full_sets(docs, materialize(own.join(members.select("set_id"), "set_id", "left_semi")
                                        .select("set_id", "first_id", "text_hash"), "minhash-wanted"), words)
    members = materialize(members.join(full, "set_id"), "minhash-member-sets")
    needed = F.ceil(F.greatest(F.sum("size") / BLOCK_SHINGLES, F.count(F.lit(1)) / BLOCK_SETS)).cast("int")
    asking, asked = members.where("query"), members
    q, t = (df.groupBy("near", F.col("range").alias(f"{name}_range")).agg(needed.alias(f"{name}_n"))
            for df, name in ((asking, "q"), (asked, "t")))
    # a row for each pair of blocks: metadata
    pairs = materialize(q.join(t, "near").where("abs(q_range - t_range) <= 1").select(
        "near", "q_range", "q_n", "t_range", "t_n", F.explode(F.sequence(F.lit(0), F.col("q_n") - 1)).alias("q_block"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("t_n") - 1)).alias("t_block")), "minhash-block-pairs")
    keys = ["near", "q_range", "q_block", "t_range", "t_block"]
    sides = []
    for df, sizes, name, seed in ((asking, q, "q", 1), (asked, t, "t", 2)):
        placed = df.withColumnRenamed("range", f"{name}_range").join(sizes.select("near", f"{name}_range", f"{name}_n"), ["near", f"{name}_range"]) \
            .withColumn(f"{name}_block", F.pmod(F.xxhash64("set_id", F.lit(seed)), F.col(f"{name}_n")).cast("int")).drop(f"{name}_n")
        sides.append(placed.join(pairs.select(*keys), ["near", f"{name}_range", f"{name}_block"])
                     .select(*keys, F.lit(name == "q").alias("asks"), "set_id", "class", "hashes"))
    return sides[0].unionByName(sides[1]).groupBy(*keys).applyInArrow(_held_against(percent), "a long, b long")


def _held_against(percent: int):
    """One block pair: its links, as few as join the same classes."""

    def run(rows: pa.Table) -> pa.Table:
        asks = rows["asks"].to_numpy()
        ids, classes = rows["set_id"].to_numpy(), rows["class"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in rows["hashes"].to_pylist()]
        q, t = np.flatnonzero(asks), np.flatnonzero(~asks)
        parent: dict = {}

        def top(x):
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        found = []
        if len(q) and len(t):
            sizes = np.array([len(sets[k]) for k in t])
            # an index of the asked sets: for each shingle the sets that hold it
            shingles = np.concatenate([sets[k] for k in t])
            holder = np.repeat(np.arange(len(t)), sizes)
            order = np.argsort(shingles, kind="stable")
            shingles, holder = shingles[order], holder[order]
            for k in q:
                own = sets[k]
                low, high = np.searchsorted(shingles, own), np.searchsorted(shingles, own, "right")
                n = high - low
                at = np.repeat(low - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
                common = np.bincount(holder[at], minlength=len(t))
                hit = np.flatnonzero(100 * common >= percent * (len(own) + sizes - common))
                for j in hit:
                    x, y = top(classes[k]), top(classes[t[j]])
                    if x != y:
                        parent[y] = x
                        found.append((ids[k], ids[t[j]]))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def _enough(pairs: DataFrame, counted: DataFrame, matches: int) -> DataFrame:
    """(a, b, n): pairs with n >= ``matches`` postings in common, counted on the whole posting lists."""
    side = lambda name: counted.select(F.col("set_id").alias(name), F.col("postings").alias(f"{name}_postings"))
    return pairs.join(side("a"), "a").join(side("b"), "b") \
        .select("a", "b", F.size(F.array_intersect("a_postings", "b_postings")).alias("n")).where(F.col("n") >= matches)
