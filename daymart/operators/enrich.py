"""Denormalisation (JOIN-1): fact-like rows left-joined to unique lookups.

The lookups are made unique by key first (``dedup_last``), so the left
join is many-to-one by construction and never multiplies rows; NULL keys
find no partner. The join strategy is left to AQE: a lookup is broadcast
only when its measured runtime size is below the broadcast threshold,
otherwise the plan stays a shuffle join - no unchecked broadcast hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_duplicates(lookup: DataFrame, key: str) -> DataFrame:
    """Keys occurring more than once (validation of many-to-one)."""
    return lookup.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def left_lookup(df: DataFrame, lookup: DataFrame, key: str, columns=None) -> DataFrame:
    cols = columns or [c for c in lookup.columns if c != key]
    return df.join(lookup.select(key, *cols), on=key, how="left")


def enrich_event(event: DataFrame, venue: DataFrame, category: DataFrame) -> DataFrame:
    """event ⟕ venue ⟕ category -> the denormalised stage.event columns."""
    out = left_lookup(event, venue, "venueid", ["venuename", "venuecity", "venuestate", "venueseats"])
    return left_lookup(out, category, "catid", ["catgroup", "catname", "catdesc"])


def denormalise(fact: DataFrame, lookups) -> DataFrame:
    """Generic star denormalisation: ``lookups`` = [(lookup_df, key, columns)]."""
    out = fact
    for lookup, key, cols in lookups:
        out = left_lookup(out, lookup, key, cols)
    return out
