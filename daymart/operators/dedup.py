"""De-duplication by key, skew-safe.

Both variants are ``row_number() over (partition by key order by ...) = 1``.
Catalyst turns this into a *partial* ``WindowGroupLimit`` before the
shuffle plus a final one after it: every map task first keeps only its
best row per key, so a key holding a third of all rows never crosses the
shuffle as one big group - at most one candidate per task and key does.
The order is total (file position or all remaining columns as the last
tiebreak), so the survivor is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _first(df: DataFrame, keys, order) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_last(df: DataFrame, keys, pos: str = "_pos") -> DataFrame:
    """Keep the last row of each key in file order (``pos`` = scan position)."""
    return _first(df, keys, [F.col(pos).desc()])


def dedup_latest(df: DataFrame, keys, ts: str, tiebreak=("_pos",)) -> DataFrame:
    """Keep the row with the latest ``ts`` per key; NULL times lose; ties go
    to the smallest ``tiebreak`` values (default: first in file)."""
    return _first(df, keys, [F.col(ts).desc_nulls_last()] + [F.col(c).asc() for c in tiebreak])
