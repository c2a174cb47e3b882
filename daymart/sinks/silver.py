"""Silver writes: contract-ordered Snappy Parquet, write-once per attempt."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymart import contracts
from daymart.errors import DataContractError
from daymart.sources.files import file_inventory, row_counts


def write_silver(df: DataFrame, path: str, name: str, num_files: int | None = None,
                 mode: str = "errorifexists") -> None:
    """Contract cast (names, order, types), then write. ``errorifexists``
    makes attempt-scoped outputs write-once; ``num_files`` repartitions
    to a fixed file count, otherwise AQE sizes the output."""
    schema = contracts.stage_schema(name)
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    if num_files:
        out = out.repartition(num_files)
    out.write.mode(mode).option("compression", "snappy").parquet(path)


def output_descriptor(spark: SparkSession, path: str, name: str, expected_rows: int | None = None) -> DataFrame:
    """Per written file: (dataset, path, bytes, sha256, rows), read back from
    storage. Raises when the files' row total differs from ``expected_rows``."""
    inv = file_inventory(spark, path, glob="*.parquet")
    counts = row_counts(spark.read.parquet(path))
    desc = inv.join(counts, "path", "left").select(
        F.lit(name).alias("dataset"), "path", "bytes", "sha256",
        F.coalesce("rows", F.lit(0)).alias("rows"))
    if expected_rows is not None:
        total = desc.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        if total != expected_rows:
            raise DataContractError(f"{name}: written rows {total} != frame rows {expected_rows}")
    return desc
