"""Writes that measure what they write: rows, content and NULLs, in the writing job itself.

The measures are one ``Observation`` directly below the write, so they cost no scan and count each task's rows once,
however often a task is repeated. The content fingerprint does not depend on the order of rows or files: the count,
the sum and the exclusive-or of two 64-bit row hashes. NULLs take part in the hashes by their place.
"""

from __future__ import annotations

import hashlib
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class Written(NamedTuple):
    path: str
    rows: int
    content: str  # fingerprint of the schema and the rows
    nulls: dict  # column -> NULLs, of the columns asked for


def row_hash(columns, seed: int) -> F.Column:
    cells = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(F.lit(seed), *cells, *[c.isNull() for c in cells])


def content_metrics(columns) -> list:
    """Aggregates over rows from which ``content_of`` makes the fingerprint."""
    return [F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(row_hash(columns, 1).cast("decimal(20,0)")), F.lit(0)).alias("total"),
            F.coalesce(F.bit_xor(row_hash(columns, 2)), F.lit(0)).alias("mixed")]


def content_of(metrics: dict, columns: list[tuple[str, str]]) -> str:
    """SHA-256 over the columns' names and types and the measured aggregates."""
    head = ",".join(f"{name} {kind}" for name, kind in columns)
    return hashlib.sha256(f"{head}|{metrics['rows']}|{int(metrics['total'])}|{metrics['mixed']}".encode()).hexdigest()


def write_observed(df: DataFrame, path: str, not_null=(), leave_out=()) -> Written:
    """Write once to a new folder. ``not_null``: columns whose NULLs are counted; ``leave_out``: columns that are not
    part of the content (load times)."""
    kept = [(n, t) for n, t in df.dtypes if n not in leave_out]
    seen = Observation(f"write-{uuid.uuid4().hex}")
    nulls = [F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"null_{c}") for c in not_null]
    df.observe(seen, *content_metrics([n for n, _ in kept]), *nulls).write.mode("errorifexists") \
        .option("compression", "snappy").parquet(path)
    got = seen.get
    return Written(path, got["rows"], content_of(got, kept), {c: got[f"null_{c}"] for c in not_null})
