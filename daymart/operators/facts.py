"""Point-in-time fact resolution against SCD2 dimensions.

A fact row resolves, per role, to the dimension version whose half-open
interval contains the transaction date: ``eff <= ts::date < exp``. A role
is an equi join on the natural key with that interval as a residual
predicate (sort-merge or hash join, or broadcast when AQE measures the
versions side small). A valid history has at most one covering version
per key and day, so a role join never multiplies fact rows. Skewed roles
(one seller with a third of the sales) are split by AQE's skew-join
handling of the fact side.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SKETCH_TOP, SKETCH_ITEMS = 1_000, 1 << 14  # hot keys a role at most; counters of a sketch


@dataclass(frozen=True)
class Role:
    dim: DataFrame          # SCD2 history
    natural: str            # natural key column in the dimension
    fact_col: str           # fact column holding the natural key
    surrogate: str          # surrogate key column in the dimension
    alias: str              # output column, e.g. seller_key


def _role_join(fact: DataFrame, r: Role, i: int, ts: str, how: str) -> DataFrame:
    d = F.col(ts).cast("date")
    v = r.dim.select(F.col(r.natural).alias(f"_nk{i}"), F.col(r.surrogate).alias(r.alias),
                     F.col("effective_date").alias(f"_eff{i}"),
                     F.col("expiry_date").alias(f"_exp{i}"))
    cond = ((F.col(r.fact_col) == F.col(f"_nk{i}"))
            & (F.col(f"_eff{i}") <= d) & (d < F.col(f"_exp{i}")))
    return fact.join(v, cond, how).drop(f"_nk{i}", f"_eff{i}", f"_exp{i}")


def hot_keys(fact: DataFrame, col: str, min_rows: int) -> DataFrame:
    """(_hot, _salts): keys holding at least ``min_rows`` fact rows and over
    how many tasks each is spread, so that a task gets about ``min_rows``.

    A partial aggregate; at most ``total_rows / min_rows`` keys qualify. The
    key keeps its type, so it compares with a dimension key as the plain
    join does.
    """
    return (fact.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("_hot"))
            .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_rows)
            .select("_hot", F.ceil(F.col("_n") / F.lit(min_rows)).cast("int").alias("_salts")))


def hot_keys_of_roles(fact: DataFrame, columns, min_rows: int, top: int = SKETCH_TOP, tracked: int = SKETCH_ITEMS) -> dict:
    """{column: [(key, salts)]} of keys with at least about ``min_rows`` rows, for all columns in one scan.

    One heavy-hitter sketch per column, of ``tracked`` counters whatever the data, merged as a partial aggregate; its
    row, at most ``top`` keys a column, is all that reaches the driver. It finds every key that holds more than about
    1.4 / ``tracked`` of the rows; keys below that share are left to adaptive execution."""
    columns = list(dict.fromkeys(columns))
    row = fact.agg(*[F.expr(f"approx_top_k(`{c}`, {top}, {tracked})").alias(f"_{i}") for i, c in enumerate(columns)]).first()
    found = {}
    for i, c in enumerate(columns):
        items = [(x["item"], x["count"]) for x in row[f"_{i}"] or [] if x["item"] is not None]
        found[c] = [(item, -(-n // min_rows)) for item, n in items if n >= min_rows]
    return found


def _salted_role_join(out: DataFrame, hot: DataFrame, r: Role, i: int, ts: str, how: str,
                      row_id: str | None = None) -> DataFrame:
    """One equi+interval join on (natural key, salt). Rows of hot keys get a
    salt below the key's number of salts from a hash of ``row_id`` (without
    one, of the row); the hot
    keys' versions are replicated once per salt, cold keys keep salt 0 and
    are not replicated. The hot set carries no hint: its measured size decides
    how it is joined."""
    d = F.col(ts).cast("date")
    row_hash = F.xxhash64(*[F.col(c) for c in ([row_id] if row_id else out.columns)])
    o = (out.join(hot, F.col(r.fact_col) == F.col("_hot"), "left")
         .withColumn(f"_salt{i}", F.coalesce(F.pmod(row_hash, F.col("_salts")), F.lit(0)))
         .drop("_hot", "_salts"))
    v = (r.dim.join(hot, F.col(r.natural) == F.col("_hot"), "left")
         .select(F.col(r.natural).alias(f"_nk{i}"), F.col(r.surrogate).alias(r.alias),
                 F.col("effective_date").alias(f"_eff{i}"), F.col("expiry_date").alias(f"_exp{i}"),
                 F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)).alias(f"_vs{i}")))
    cond = ((F.col(r.fact_col) == F.col(f"_nk{i}")) & (F.col(f"_salt{i}") == F.col(f"_vs{i}"))
            & (F.col(f"_eff{i}") <= d) & (d < F.col(f"_exp{i}")))
    return o.join(v, cond, how).drop(f"_nk{i}", f"_eff{i}", f"_exp{i}", f"_salt{i}", f"_vs{i}")


def resolve_roles(fact: DataFrame, ts: str, roles, how: str = "left",
                  hot_threshold: int | None = None, row_id: str | None = None, hot: dict | None = None) -> DataFrame:
    """Add one surrogate column per role; NULL when no version covers ts.

    ``hot_threshold``: keys with at least that many fact rows are spread over
    ceil(rows / threshold) tasks (their versions replicated as often), so a
    key holding a third of all facts never lands in one task. One scan finds
    the hot keys of all roles; a role without any is a plain join. Without a
    threshold, AQE's skew-join splitting handles oversized partitions at
    runtime. ``row_id``: a column that tells facts apart, for the salt.
    ``hot``: what ``hot_keys_of_roles`` has found already.
    """
    if hot is None:
        hot = hot_keys_of_roles(fact, [r.fact_col for r in roles], hot_threshold) if hot_threshold is not None else {}
    out = fact
    for i, r in enumerate(roles):
        keys = hot.get(r.fact_col)
        if not keys:
            out = _role_join(out, r, i, ts, how)
        else:
            kind = fact.schema[r.fact_col].dataType.simpleString()
            few = fact.sparkSession.createDataFrame(keys, f"_hot {kind}, _salts int")  # SKETCH_TOP rows at most
            out = _salted_role_join(out, few, r, i, ts, how, row_id)
    return out


def coverage_flags(resolved: DataFrame, ts: str, load_date, aliases) -> DataFrame:
    """Per-row reasons a new fact cannot be loaded."""
    ld = F.lit(load_date).cast("date")
    flags = [F.col(ts).isNull().alias("null_time"),
             (F.col(ts).cast("date") > ld).alias("after_load_date")]
    flags += [F.col(a).isNull().alias(f"missing_{a}") for a in aliases]
    return resolved.select("*", *flags)


def coverage_counts(resolved: DataFrame, ts: str, load_date, aliases) -> DataFrame:
    """One row of counts by reason (the loader fails when ``bad`` > 0)."""
    f = coverage_flags(resolved, ts, load_date, aliases)
    reasons = ["null_time", "after_load_date"] + [f"missing_{a}" for a in aliases]
    any_bad = reduce(lambda a, b: a | b, [F.col(r) for r in reasons])
    return f.agg(F.count(F.lit(1)).alias("new_facts"),
                 *[F.count(F.when(F.col(r), 1)).alias(r) for r in reasons],
                 F.count(F.when(any_bad, 1)).alias("bad"))


def new_facts(stage: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Stage facts whose id is not yet in the fact table (anti join)."""
    return stage.join(existing.select(key), key, "left_anti")


def append_new(resolved: DataFrame, existing: DataFrame, key: str, aliases,
               with_load_ts: bool = True) -> DataFrame:
    """Resolved facts to append: every role covered, id not yet present.
    Existing rows are never rewritten."""
    ok = reduce(lambda a, b: a & b, [F.col(a).isNotNull() for a in aliases])
    out = new_facts(resolved.filter(ok), existing, key)
    return out.withColumn("load_ts", F.current_timestamp()) if with_load_ts else out


def stage_key_violations(stage: DataFrame, key: str) -> DataFrame:
    """Duplicate or NULL fact ids in a stage table."""
    return (stage.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .filter((F.col("n") > 1) | F.col(key).isNull()))


def temporal_audit(fact: DataFrame, fact_id: str, ts: str, refs) -> DataFrame:
    """(fact_id, role, reason) for fact rows whose referenced version does
    not exist or does not cover the transaction date.

    ``refs`` = [(dim, surrogate, fact_col, role)].
    """
    d = F.col(ts).cast("date")
    parts = []
    for dim, surrogate, fact_col, role in refs:
        v = dim.select(F.col(surrogate).alias("_sk"), F.col("effective_date").alias("_eff"),
                       F.col("expiry_date").alias("_exp"))
        j = fact.select(fact_id, ts, fact_col).join(v, F.col(fact_col) == F.col("_sk"), "left")
        reason = (F.when(F.col("_sk").isNull(), F.lit("missing_version"))
                  .when(F.col(ts).isNull(), F.lit("null_time"))
                  .when((d < F.col("_eff")) | (d >= F.col("_exp")), F.lit("outside_interval")))
        parts.append(j.select(fact_id, F.lit(role).alias("role"), reason.alias("reason"))
                     .filter(F.col("reason").isNotNull()))
    return reduce(DataFrame.unionByName, parts)


def not_null_violations(df: DataFrame, columns, table: str) -> DataFrame:
    """(table, column) for each NOT NULL column holding a NULL."""
    agg = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    stacked = agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in columns])).alias("x"))
    return stacked.filter("x.n > 0").select(F.lit(table).alias("table"), "x.column", "x.n")
