"""Calendar dimension (dim.date).

``dateid`` counts days from an epoch: caldate = 2003-01-01 + (dateid - 1),
so dateid 1827 is 2008-01-01 and 4382 is 2014-12-30 (fixed values of the
data model). Rows come from ``spark.range`` - no digit cross joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values ---------------------------------------------------------
EPOCH = "2003-01-01"   # caldate of dateid 1
FIRST_ID = 1827        # 2008-01-01
LAST_ID = 4382         # 2014-12-30
# ---- end of fixed values --------------------------------------------------


def _rows(ids: DataFrame) -> DataFrame:
    d = F.date_add(F.lit(EPOCH).cast("date"), (F.col("dateid") - 1).cast("int"))
    return ids.select(F.col("dateid").cast("int").alias("dateid"), d.alias("caldate")).select(
        "dateid", "caldate",
        F.date_format("caldate", "EEE").alias("day"),
        F.weekofyear("caldate").cast("short").alias("week"),
        F.date_format("caldate", "MMM").alias("month"),
        F.quarter("caldate").cast("string").alias("qtr"),
        F.year("caldate").cast("short").alias("year"),
        F.lit(False).alias("holiday"))


def calendar(spark: SparkSession, lo: int = FIRST_ID, hi: int = LAST_ID) -> DataFrame:
    """Inclusive dateid range lo..hi."""
    return _rows(spark.range(lo, hi + 1).withColumnRenamed("id", "dateid"))


def date_to_id(c) -> F.Column:
    return (F.datediff(F.col(c).cast("date") if isinstance(c, str) else c.cast("date"),
                       F.lit(EPOCH).cast("date")) + 1)


def calendar_for(df: DataFrame, ts_col: str) -> DataFrame:
    """Calendar rows spanning the dates present in ``df`` (one aggregate
    for the bounds, then a generated sequence of at most span-days rows)."""
    b = df.agg(F.min(date_to_id(ts_col)).alias("lo"), F.max(date_to_id(ts_col)).alias("hi"))
    ids = b.filter(F.col("lo").isNotNull()).select(
        F.explode(F.sequence(F.col("lo"), F.col("hi"))).alias("dateid"))
    return _rows(ids)


def merge_calendar(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Idempotent insert: only dateids not yet present are appended."""
    return existing.unionByName(new.join(existing.select("dateid"), "dateid", "left_anti"))
