"""Type-2 slowly changing dimensions over half-open date intervals.

A version is valid on day d when ``effective_date <= d < expiry_date``;
the current version has ``expiry_date = 9999-12-31`` and ``is_current``.

* ``validate_history`` - one shuffle by natural key (window), all rules.
* ``interval_overlaps`` - overlap audit via a running max of the previous
  expiry dates (no self join).
* ``dimension_guards`` - ordered violation rows for one daily load.
* ``classify`` / ``scd2_apply`` - one full outer join of current rows and
  the snapshot classifies every key (new, changed, unchanged, missing);
  the same frame feeds the guards and the new history.

Per-key groups in these windows are the versions of one key - one per
load day at most - so no window group grows with the fact data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymart.contracts import OPEN_END
from daymart.operators.keys import assign_keys

# ---- fixed values: guard messages, in evaluation order --------------------
GUARD_MESSAGES = {
    "load_date": "A non-null load date below 9999-12-31 is required",
    "invalid_history": "Invalid dim.{dataset} history: gaps, overlaps, invalid ranges or current rows",
    "out_of_order": "Out-of-order dimension snapshot; replay snapshots chronologically",
    "stage_key": "stage.{dataset} requires unique non-null {key}",
    "same_day_new_key": "Changed same-day {dataset} snapshot: new keys on an already processed date",
    "same_day_changed": "Changed same-day {dataset} snapshot: daily history cannot represent intraday changes",
}
# ---- end of fixed values --------------------------------------------------


def _open_end() -> Column:
    return F.lit(OPEN_END).cast("date")


def validate_history(dim: DataFrame, key: str) -> DataFrame:
    """(key, effective_date, rule) for every broken history invariant:
    not exactly one current row; eff >= exp; a non-last version whose expiry
    differs from the next start or that is current; a last version that is
    not current or not open-ended."""
    w = Window.partitionBy(key).orderBy("effective_date")
    wk = Window.partitionBy(key)
    h = dim.select(key, "effective_date", "expiry_date", "is_current",
                   F.lead("effective_date").over(w).alias("_next"),
                   F.sum(F.when(F.col("is_current"), 1).otherwise(0)).over(wk).alias("_cur"),
                   F.row_number().over(w).alias("_rn"))
    nxt = F.col("_next")
    rules = [
        ("current_count", (F.col("_cur") != 1) & (F.col("_rn") == 1)),
        ("invalid_range", F.col("effective_date") >= F.col("expiry_date")),
        ("gap_or_overlap", nxt.isNotNull() & (F.col("expiry_date") != nxt)),
        ("closed_is_current", nxt.isNotNull() & F.col("is_current")),
        ("open_end", nxt.isNull() & (~F.col("is_current") | (F.col("expiry_date") != _open_end()))),
    ]
    flagged = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules]), lambda x: x.isNotNull())
    return h.select(key, "effective_date", F.explode(flagged).alias("rule"))


def interval_overlaps(dim: DataFrame, key: str, surrogate: str) -> DataFrame:
    """Versions that start before an earlier version of the same key ends."""
    w = (Window.partitionBy(key).orderBy("effective_date", surrogate)
         .rowsBetween(Window.unboundedPreceding, -1))
    h = dim.select(key, surrogate, "effective_date",
                   F.max("expiry_date").over(w).alias("_prev_max_exp"))
    return h.filter(F.col("effective_date") < F.col("_prev_max_exp")).drop("_prev_max_exp")


def classify(dim: DataFrame, snapshot: DataFrame, key: str, attrs) -> DataFrame:
    """current ⟗ snapshot on key: one row per key with both sides as structs
    and the flags ``_has_cur``, ``_has_new``, ``_changed``."""
    cur = dim.filter(F.col("is_current"))
    cur_s = cur.select(F.col(key).alias("_k"), F.struct(*cur.columns).alias("d"))
    snap_s = snapshot.select(F.col(key).alias("_k"), F.struct(*snapshot.columns).alias("s"))
    j = cur_s.join(snap_s, "_k", "full_outer")
    changed = reduce(lambda a, b: a | b, [~F.col(f"d.{a}").eqNullSafe(F.col(f"s.{a}")) for a in attrs])
    return j.select("_k", "d", "s",
                    F.col("d").isNotNull().alias("_has_cur"),
                    F.col("s").isNotNull().alias("_has_new"),
                    (F.col("d").isNotNull() & F.col("s").isNotNull() & changed).alias("_changed"))


def dimension_guards(dim: DataFrame, snapshot: DataFrame, key: str, attrs, load_date,
                     watermark: DataFrame, dataset: str, cls: DataFrame | None = None,
                     order: int = 0, processed: bool | None = None) -> DataFrame:
    """Violation rows (priority, rule, dataset, key) of one dimension load.

    Priority follows the evaluation order of the loader, so the first row
    by priority is the message a user sees: load date; history of every
    dimension; out-of-order of every dimension; then per dimension (in
    ``order``) stage keys, same-day new keys, same-day changes.
    ``load_date`` is a date string. ``processed`` (load date already in the
    watermark) may be passed by callers that hold the watermark as metadata.
    """
    ld = F.lit(load_date).cast("date")
    if processed is None:
        # the watermark holds one row per processed day: a scalar existence probe
        processed = watermark.filter(F.col("load_date") == ld).limit(1).count() > 0
    parts = []

    def rows(df, prio, rule, kcol):
        prio = prio + order if prio < 30 else prio + 10 * order
        return df.select(F.lit(prio).alias("priority"), F.lit(rule).alias("rule"),
                         F.lit(dataset).alias("dataset"), F.col(kcol).cast("string").alias("key"))

    spark = dim.sparkSession
    bad_date = spark.range(1).filter(ld.isNull() | (ld >= _open_end()))
    parts.append(rows(bad_date.withColumn("k", F.lit(None)), 0, "load_date", "k"))
    parts.append(rows(validate_history(dim, key), 10, "invalid_history", key))
    later_marks = watermark.filter(F.col("load_date") > ld).withColumn("k", F.lit(None))
    parts.append(rows(later_marks, 20, "out_of_order", "k"))
    parts.append(rows(dim.filter(F.col("effective_date") > ld), 20, "out_of_order", key))
    dup = (snapshot.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
           .filter((F.col("n") > 1) | F.col(key).isNull()))
    parts.append(rows(dup, 30, "stage_key", key))
    c = cls if cls is not None else classify(dim, snapshot, key, attrs)
    if processed:
        parts.append(rows(c.filter(F.col("_has_new") & ~F.col("_has_cur")), 31, "same_day_new_key", "_k"))
    same_day = c.filter(F.col("_changed"))
    if not processed:
        same_day = same_day.filter(F.col("d.effective_date") >= ld)
    parts.append(rows(same_day, 32, "same_day_changed", "_k"))
    return reduce(DataFrame.unionByName, parts)


def guard_message(row, key: str) -> str:
    return GUARD_MESSAGES[row["rule"]].format(dataset=row["dataset"], key=key)


def scd2_apply(dim: DataFrame, snapshot: DataFrame, key: str, attrs, surrogate: str,
               load_date, cls: DataFrame | None = None, parts: bool = False):
    """New full history after applying one daily snapshot.

    closed = changed current rows with expiry = load_date, not current;
    kept = current rows that are unchanged or missing from the snapshot
    (absence is not a deletion); inserted = changed ∪ brand-new keys with
    effective = load_date, open end, new surrogate keys after the maximum
    existing key. NULL transitions count as changes.
    """
    ld = F.lit(load_date).cast("date")
    c = cls if cls is not None else classify(dim, snapshot, key, attrs)
    dim_cols = dim.columns
    snap_cols = [x for x in dim_cols if x not in (surrogate, "effective_date", "expiry_date", "is_current")]

    history = dim.filter(~F.col("is_current"))
    kept = c.filter(F.col("_has_cur") & ~F.col("_changed")).select("d.*")
    closed = (c.filter(F.col("_changed")).select("d.*")
              .withColumn("expiry_date", ld).withColumn("is_current", F.lit(False)))
    inserted = (c.filter(F.col("_has_new") & (~F.col("_has_cur") | F.col("_changed")))
                .select(*[F.col(f"s.{x}").cast(dim.schema[x].dataType).alias(x) for x in snap_cols])
                .withColumn("effective_date", ld)
                .withColumn("expiry_date", _open_end())
                .withColumn("is_current", F.lit(True)))
    # keys continue after the largest existing one (one scalar; measured
    # faster than a scalar subquery, which re-plans the history under it)
    start = dim.agg(F.coalesce(F.max(surrogate), F.lit(0)).cast("long")).first()[0]
    keyed = assign_keys(inserted, key, surrogate, start=start)
    if parts:  # (newly closed versions, new current rows) for versioned publication
        return (closed.select(*dim_cols),
                kept.select(*dim_cols).unionByName(keyed.select(*dim_cols)))
    return reduce(DataFrame.unionByName,
                  [history.select(*dim_cols), kept.select(*dim_cols),
                   closed.select(*dim_cols), keyed.select(*dim_cols)])


def empty_dim(spark, snapshot: DataFrame, surrogate: str) -> DataFrame:
    """An empty history with the snapshot's columns (first load)."""
    from pyspark.sql import types as T
    fields = [T.StructField(surrogate, T.LongType(), False)] + list(snapshot.schema.fields) + [
        T.StructField("effective_date", T.DateType(), False),
        T.StructField("expiry_date", T.DateType(), False),
        T.StructField("is_current", T.BooleanType(), False)]
    return spark.createDataFrame([], T.StructType(fields))
