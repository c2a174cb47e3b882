"""Cut lineage by writing a table into the cluster's shared checkpoint folder.

``spark.checkpoint.dir`` names a shared, fault-tolerant location; a
Parquet table written there survives executor loss (unlike cached blocks)
and is read back column-pruned, which makes it cheaper than an RDD
checkpoint for wide rows.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from daymart.session import checkpoint_dir


def materialize(df: DataFrame, name: str = "mat") -> DataFrame:
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/daymart-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def sweep(spark: SparkSession, keep_seconds: float, now: float | None = None) -> list[str]:
    """Delete tables of this folder that were last changed longer than ``keep_seconds`` ago (give more than the longest
    job takes: a plan that still reads one needs it). Returns what was deleted."""
    from daymart.sinks.hadoop import Files

    now = time.time() if now is None else now
    folder = f"{checkpoint_dir(spark).rstrip('/')}/daymart-tables"
    files = Files(spark, folder)
    gone = [f"{folder}/{name}" for name, is_dir, ms in files.listed(folder) if is_dir and ms / 1000 < now - keep_seconds]
    for path in gone:
        files.delete(path)
    return gone
