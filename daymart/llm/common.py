"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daymart.session import checkpoint_dir
from daymart.sinks.materialize import materialize

__all__ = ["arrow_rows", "batches", "checkpoint_dir", "components", "joined_components", "lower_words", "materialize", "parts", "table",
           "text_bytes"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased, as UTF-8.

    ``bytes.lower`` and ``bytes.split`` touch exactly ASCII letters and those six separators.
    """
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def text_bytes(df: DataFrame, col: str) -> int:
    """Total bytes of a text column (one aggregate; only the sum reaches the driver)."""
    row = df.agg(F.sum(F.coalesce(F.octet_length(col), F.lit(0)).cast("long")).alias("b")).first()
    return int(row["b"] or 0)


def parts(n_bytes: int, per_part: int, least: int = 1) -> int:
    """Number of blocks so that each holds about ``per_part`` bytes."""
    return max(least, math.ceil(n_bytes / per_part))


def arrow_rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)


def batches(rows, schema: pa.Schema, size: int = 4096):
    """Arrow batches of at most ``size`` rows from an iterator of tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield arrow_rows(held, schema)
            held = []
    if held:
        yield arrow_rows(held, schema)


def components(edges: DataFrame, name: str = "cc", rounds: int | None = None) -> DataFrame:
    """(node, component): the smallest node reachable over undirected ``edges`` (a, b); a row per node of an edge.

    Rounds of "take the smallest label among the neighbours, then follow the label's own label" until nothing
    changes: a logarithmic number of rounds on usual graphs. Each round is a table in the shared folder, so a lost
    executor costs one round at most; the write itself counts the changes. Aggregates combine before the shuffle and the
    joins are plain equi joins that adaptive execution splits when a node is hot; no link or label reaches the driver.
    With ``rounds``, only so many: nodes of one component may then have several labels, nodes of different ones never
    share one.
    """
    spark = edges.sparkSession
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .where("a <> b").distinct(), f"{name}-edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")) \
        .select("node", F.least("node", "m").alias("component"))
    labels, done = materialize(labels, f"{name}-labels"), 0
    while rounds is None or done < rounds:
        near = (both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("c")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("c").alias("c")))
        stepped = labels.join(near, "node", "left").select(
            "node", F.col("component").alias("old"), F.least("component", "c").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("jumped"))
        seen = Observation()
        labels = materialize(stepped.join(jump, "to", "left").select(
            "node", F.least("to", "jumped").alias("component"), "old")
            .observe(seen, F.count(F.when(F.col("component") != F.col("old"), 1)).alias("changed")), f"{name}-labels")
        labels, done = labels.select("node", "component"), done + 1
        if not seen.get["changed"]:
            break
    return labels


def joined_components(labels: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """(node, component) over ``edges`` (a, b) between nodes that have a label already (node, label): nodes of one label
    belong together. Only labels that an edge joins are worked on."""
    side = lambda x: labels.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}"))
    between = edges.join(side("a"), "a", "left").join(side("b"), "b", "left").select(
        F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")).where("a <> b").distinct()
    found = components(between, name).withColumnsRenamed({"node": "label", "component": "joined"})
    return labels.join(found, "label", "left").select("node", F.coalesce("joined", "label").alias("component"))
