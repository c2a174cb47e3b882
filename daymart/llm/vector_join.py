"""Embedding near-duplicates by collision-counting projections.

Vectors are projected on many random lines. In one table, ``k - 1`` companion lines cut the space into cells and the
rows of a cell are ordered along one more line; two rows collide when they lie in one cell and within a window
centred on the row that asks. (Windows on single lines alone hold a fixed share of all rows, whatever their number;
the companions keep them short.) Collisions of a pair are counted over all tables, and a pair is verified when it
collides ``least`` times: the number of tables is the smallest for which a pair at the required cosine collides that
often with probability 1 - ``miss``; closer pairs collide more. Cells get finer with the logarithm of the number of
rows, so a row meets a bounded number of strangers.

Groups of copies do not meet in pairs: equal vectors are one row; each cell first links its rows to one leader; only
cells that still hold rows of several classes are joined, pairs of one class excepted. What is verified completes the
classes. Links are then counted exactly, inside each class, in blocks of rows against blocks of rows: a link never
leaves its class, so no link is lost that the search has put into a class.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing: a component of their own.
Vectors of different lengths do not link. Rows are kept as they come: ids given twice and repeated rows are copies;
the smallest id ignores nulls. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.llm.common import components, materialize

WIDTH, WINDOW, BLOCK = 2.4, 1.2, 4096


def _normal(x: float) -> float:
    return math.erf(x / math.sqrt(2))


def chance(spread: float, k: int) -> float:
    """Probability that two rows collide in a table, their difference along a line having that deviation."""
    t = WIDTH / spread
    cell = _normal(t) - 2 / t * (1 / math.sqrt(2 * math.pi)) * (1 - math.exp(-t * t / 2))
    return cell ** (k - 1) * _normal(WINDOW / spread)


def plan(rows: int, cosine: float, least: int = 2, miss: float = 0.001) -> tuple[int, int]:
    """(lines per table, tables): strangers per row and table about one, then as many tables as recall needs."""
    k = 2
    while rows * chance(math.sqrt(2), k) > 1:
        k += 1
    p = chance(math.sqrt(2 - 2 * cosine), k)
    tables = least
    while sum(math.comb(tables, i) * p ** i * (1 - p) ** (tables - i) for i in range(least)) > miss:
        tables += 1
    return k, tables


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    v = vectors / np.abs(vectors).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _matrix(column, dims: int) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(-1, dims)


def postings(rows: DataFrame, k: int, tables: int, seed: int = 17) -> DataFrame:
    """(rep, cell, value): every row's cell and place in each table."""

    def run(found):
        for batch in found:
            ids, lists = batch.column(0).to_numpy(), batch.column(1)
            sizes = np.array([len(x) for x in lists])
            for dims in np.unique(sizes):
                rng = np.random.default_rng((seed, int(dims)))
                lines = rng.standard_normal((dims, tables * k))
                shift = rng.uniform(0, WIDTH, tables * k)
                mix = rng.integers(1, 1 << 62, k - 1, dtype=np.int64) * 2 + 1
                which = np.flatnonzero(sizes == dims)
                for at in range(0, len(which), 1024):
                    part = which[at:at + 1024]
                    p = (unit(_matrix(lists.take(pa.array(part)), dims)) @ lines).reshape(len(part), tables, k)
                    cells = np.floor((p[:, :, 1:] + shift.reshape(tables, k)[:, 1:]) / WIDTH).astype(np.int64)
                    with np.errstate(over="ignore"):
                        cell = (cells * mix).sum(2) * 2654435761 + np.arange(tables) * 1_000_003 + int(dims)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[part]), pa.array(list(cell), pa.list_(pa.int64())),
                         pa.array(list(p[:, :, 0].astype(np.float32)), pa.list_(pa.float32()))],
                        names=["rep", "cells", "places"])

    made = rows.select("rep", "vector").mapInArrow(run, "rep long, cells array<long>, places array<float>")
    return made.select("rep", F.explode(F.arrays_zip(F.sequence(F.lit(0), F.size("cells") - 1).alias("t"), "cells",
                                                     "places")).alias("p")) \
        .select("rep", F.xxhash64("p.t", "p.cells").alias("cell"), F.col("p.places").alias("place"))


def _verify(pairs: DataFrame, rows: DataFrame, cosine: float) -> DataFrame:
    """The pairs (a, b) with that cosine in double precision."""
    side = lambda name: rows.select(F.col("rep").alias(name), F.col("vector").alias(f"{name}_vector"))

    def run(found):
        for batch in found:
            x, y = batch.column(2), batch.column(3)
            keep = np.zeros(batch.num_rows, bool)
            sizes = np.array([len(v) if len(v) == len(w) else 0 for v, w in zip(x, y)], int)
            for dims in np.unique(sizes[sizes > 0]):
                which = pa.array(np.flatnonzero(sizes == dims))
                cos = (unit(_matrix(x.take(which), dims)) * unit(_matrix(y.take(which), dims))).sum(1)
                keep[which.to_numpy()] = cos >= cosine
            yield batch.select([0, 1]).filter(pa.array(keep))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_vector", "b_vector") \
        .mapInArrow(run, "a long, b long")


def _counts(classed: DataFrame, cosine: float) -> DataFrame:
    """(rep, links): copies that each row's verified partners in its class stand for, itself excepted."""
    sizes = classed.groupBy("class").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    large = F.ceil(F.col("members") / BLOCK).cast("int")
    rows = classed.join(sizes, "class").withColumn("blocks", large) \
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # a row meets the rows of its own block and of every block; classes of one block share a group by hash
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = rows.withColumn("i", other).withColumn("lo", F.least("own", "i")).withColumn("hi", F.greatest("own", "i"))
    n = max(1, classed.count() // 20_000)
    group = F.when(F.col("blocks") > 1, F.xxhash64("class")).otherwise(F.pmod(F.xxhash64("class"), F.lit(n)))

    def run(found: pa.Table) -> pa.Table:
        classes = np.array(found.column("class").to_numpy())
        reps, own = found.column("rep").to_numpy(), found.column("own").to_numpy()
        copies, vectors = found.column("copies").to_numpy(), found.column("vector").combine_chunks()
        hi = int(found.column("hi")[0].as_py())
        out_rep, out_links = [], []
        order = np.argsort(classes, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(classes[order])) + 1):
            lists = vectors.take(pa.array(part))
            dims = len(lists[0])
            x = unit(_matrix(lists, dims))
            left = own[part] == found.column("lo")[0].as_py()
            right = own[part] == hi
            links = np.zeros(len(part), np.int64)
            same = found.column("lo")[0].as_py() == hi
            near = x[left] @ x[right].T >= cosine
            if same:
                np.fill_diagonal(near, False)
            links[left] += near @ copies[part][right]
            if not same:
                links[right] += near.T @ copies[part][left]
            out_rep.append(reps[part])
            out_links.append(links)
        return pa.table([pa.array(np.concatenate(out_rep)), pa.array(np.concatenate(out_links))],
                        names=["rep", "links"])

    return dealt.withColumn("group", group).groupBy("group", "lo", "hi").applyInArrow(run, "rep long, links long") \
        .groupBy("rep").agg(F.sum("links").alias("links"))


def near_vectors(vectors: DataFrame, cosine: float = 0.9, least: int = 2, miss: float = 0.001, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"),
                          vectors[vector_col].cast("array<double>").alias("vector"))
    usable = F.coalesce(F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
                        & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("vector", F.when(usable, F.col("vector"))).withColumn("key", F.xxhash64("vector"))
    good = rows.where("vector is not null")
    reps = materialize(good.groupBy("vector").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
                       .withColumn("rep", F.xxhash64("vector")), "vector-rows")
    k, tables = plan(reps.count(), cosine, least)
    posted = materialize(postings(reps, k, tables), "vector-postings")
    near = F.abs(F.col("place") - F.col("leader.place")) <= WINDOW
    leaders = posted.groupBy("cell").agg(F.min(F.struct("rep", "place")).alias("leader"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1")
    pairs = posted.join(leaders, "cell").where((F.col("rep") != F.col("leader.rep")) & near) \
        .select(F.col("leader.rep").alias("a"), F.col("rep").alias("b"))
    enough = lambda p: p.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("a", "b")
    links = materialize(_verify(enough(pairs), reps, cosine), "vector-leader-links")
    classes = components(links, "vector-classes").withColumnRenamed("node", "rep")
    classed = posted.join(classes, "rep", "left").select("rep", "cell", "place", F.coalesce("component", "rep").alias("class"))
    classed = materialize(classed, "vector-classed")
    mixed = classed.groupBy("cell").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo < hi")
    open_ = classed.join(mixed.select("cell"), "cell", "left_semi")
    left, right = (open_.select("cell", F.col("rep").alias(x), F.col("class").alias(f"class_{x}"),
                                F.col("place").alias(f"place_{x}")) for x in "ab")
    met = left.join(right, "cell").where((F.col("a") < F.col("b")) & (F.col("class_a") != F.col("class_b"))
                                         & (F.abs(F.col("place_a") - F.col("place_b")) <= WINDOW)).select("a", "b")
    links = materialize(links.union(_verify(enough(met), reps, cosine)), "vector-links")
    found = components(links, "vector-components").withColumnRenamed("node", "rep")
    classed = materialize(reps.join(found, "rep", "left").withColumn("class", F.coalesce("component", "rep")),
                          "vector-labels")
    first = classed.groupBy("class").agg(F.min("first_id").alias("component_id"))
    counts = _counts(classed.select("rep", "class", "copies", "vector"), cosine)
    by_rep = classed.select("rep", "class", "copies").join(first, "class").join(counts, "rep", "left") \
        .select(F.col("rep").alias("key"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.select("vec_id", F.when(F.col("vector").isNotNull(), F.col("key")).alias("key")).join(by_rep, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
