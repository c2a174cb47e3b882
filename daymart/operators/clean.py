"""Dataset cleaners (Bronze text -> typed Silver rows in stage order).

Each cleaner is a pure ``DataFrame -> DataFrame`` plan of built-in
expressions; with ``steps`` it counts rows between its steps (observations in
the writing job instead of repeated ``count()`` actions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart import contracts
from daymart.functions.columns import (bool_token, lenient_int, money, parse_timestamp, seats,
                                       state_code, strict_int, strip)
from daymart.operators.dedup import dedup_last, dedup_latest
from daymart.operators.steps import Steps, watch

DEC = "decimal(8,2)"


def _finish(df: DataFrame, name: str) -> DataFrame:
    """Contract cast: names, order and physical types of the stage table."""
    schema = contracts.stage_schema(name)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def clean_category(raw: DataFrame, steps: Steps | None = None) -> DataFrame:
    df = raw.select(lenient_int("catid", "long").alias("catid"),
                    F.upper(strip("catgroup")).alias("catgroup"),
                    strip("catname").alias("catname"), strip("catdesc").alias("catdesc"), "_pos")
    df = watch(steps, df, "parsed", bad_keys=F.col("catid").isNull()).filter(F.col("catid").isNotNull())
    return watch(steps, _finish(dedup_last(df, "catid"), "category"), "out")


def clean_venue(raw: DataFrame, steps: Steps | None = None) -> DataFrame:
    """Venue: invalid or missing state -> '' (unlike the event path)."""
    df = raw.select(lenient_int("venueid", "long").alias("venueid"),
                    strip("venuename").alias("venuename"), strip("venuecity").alias("venuecity"),
                    state_code("venuestate", invalid="").alias("venuestate"),
                    seats("venueseats").alias("venueseats"), "_pos")
    df = watch(steps, df, "parsed", bad_keys=F.col("venueid").isNull()).filter(F.col("venueid").isNotNull())
    return watch(steps, _finish(dedup_last(df, "venueid"), "venue"), "out")


def clean_users(raw: DataFrame, steps: Steps | None = None) -> DataFrame:
    cols = [lenient_int("userid", "long").alias("userid")]
    cols += [strip(c).alias(c) for c in ("username", "firstname", "lastname", "city")]
    cols += [state_code("state").alias("state"), F.lower(strip("email")).alias("email"),
             strip("phone").alias("phone")]
    cols += [bool_token(c).alias(c) for c in contracts.BOOL_COLUMNS]
    df = watch(steps, raw.select(*cols, "_pos"), "parsed", bad_keys=F.col("userid").isNull())
    df = df.filter(F.col("userid").isNotNull())
    return watch(steps, _finish(dedup_last(df, "userid"), "users"), "out")


def _lookup_key(c: str, kind: str, mode: str):
    # strict lookup key: blank rows are dropped, other text must be an integer
    return strict_int(c, kind) if mode == "strict" else lenient_int(c, kind)


def clean_event(event_raw: DataFrame, venue_raw: DataFrame, category_raw: DataFrame,
                mode: str = "strict", steps: Steps | None = None) -> DataFrame:
    """Event cleaner with denormalisation of venue and category (JOIN-1)."""
    from daymart.operators.enrich import enrich_event

    nullable = (lambda c, k: _strict_nullable(c, k)) if mode == "strict" else lenient_int
    ev = event_raw.select(
        lenient_int("eventid", "long").alias("eventid"),
        nullable("venueid", "long").alias("venueid"),
        nullable("catid", "long").alias("catid"),
        nullable("dateid", "int").alias("dateid"),
        strip("eventname").alias("eventname"),
        parse_timestamp("starttime").alias("starttime"), "_pos",
    )
    ev = watch(steps, ev, "parsed", bad_keys=F.col("eventid").isNull()).filter(F.col("eventid").isNotNull())
    venue = (venue_raw.filter(F.col("venueid").isNotNull() & (strip("venueid") != ""))
             .select(_lookup_key("venueid", "long", mode).alias("venueid"),
                     strip("venuename").alias("venuename"), strip("venuecity").alias("venuecity"),
                     state_code("venuestate").alias("venuestate"),
                     seats("venueseats").alias("venueseats"), "_pos")
             .filter(F.col("venueid").isNotNull()))
    cat = (category_raw.filter(F.col("catid").isNotNull() & (strip("catid") != ""))
           .select(_lookup_key("catid", "long", mode).alias("catid"),
                   F.upper(strip("catgroup")).alias("catgroup"),
                   strip("catname").alias("catname"), strip("catdesc").alias("catdesc"), "_pos")
           .filter(F.col("catid").isNotNull()))
    merged = enrich_event(ev, dedup_last(venue, "venueid").drop("_pos"),
                          dedup_last(cat, "catid").drop("_pos"))
    return watch(steps, _finish(dedup_last(merged, "eventid"), "event"), "out")


def _strict_nullable(c: str, kind: str):
    """Nullable integer column: missing stays NULL, fractional/garbage text fails."""
    x = strip(c)
    ok = lenient_int(c, kind)
    bad = F.col(c).isNotNull() & (x != "") & (ok.isNull() | (ok.cast("double") != x.try_cast("double")))
    return F.when(bad, F.raise_error(F.concat(F.lit(f"invalid integer in {c}: "), F.col(c)))
                  .cast(kind)).otherwise(ok)


def _typed(c: str, t: str, mode: str):
    """Contract cast of a Bronze text cell: strict raises, permissive -> NULL."""
    x = strip(c)
    if t == "timestamp_ntz":
        parsed = parse_timestamp(c)
    elif t.startswith("decimal"):
        p, sc = (int(v) for v in t[len("decimal("):-1].split(","))
        parsed = money(c, p, sc)
    else:
        parsed = x.try_cast(t)
    if mode != "strict":
        return parsed
    return F.when(F.col(c).isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit(f"malformed {c}: "), F.col(c))).cast(t)).otherwise(parsed)


def time_gate_violations(df: DataFrame, ts: str, key: str) -> DataFrame:
    """Rows with a NULL transaction time (any such row fails the job; checked
    before key filtering, so a keyless row can fail it too)."""
    return df.filter(F.col(ts).isNull()).select(F.col(key).alias("key"),
                                                F.lit(f"null_{ts}").alias("rule"))


def _to_contract(raw: DataFrame, name: str, mode: str) -> DataFrame:
    """Text columns are parsed to their contract type (strict raises on
    malformed cells); already-typed columns are cast."""
    cols = []
    for f in contracts.stage_schema(name).fields:
        is_text = isinstance(raw.schema[f.name].dataType, T.StringType)
        if is_text and not isinstance(f.dataType, T.StringType):
            cols.append(_typed(f.name, f.dataType.simpleString(), mode).alias(f.name))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return raw.select(*cols, "_pos")


def _transactions(raw: DataFrame, name: str, ts: str, defaults: dict, mode: str,
                  extra_filter=None, steps: Steps | None = None) -> DataFrame:
    if "_pos" not in raw.columns:
        raw = raw.withColumn("_pos", F.monotonically_increasing_id())
    typed = _to_contract(raw, name, mode)
    key = contracts.KEYS[name]
    df = watch(steps, typed, "parsed", bad_keys=F.col(key).isNull()).filter(F.col(key).isNotNull())
    if extra_filter is not None:
        df = watch(steps, df.filter(extra_filter), "kept")
    df = df.na.fill(defaults)
    return watch(steps, _finish(dedup_latest(df, key, ts), name), "out")


def clean_listing(raw: DataFrame, mode: str = "strict", steps: Steps | None = None) -> DataFrame:
    """listid not null; NULL tickets/prices -> 0; latest listtime wins.
    (The NULL-time gate is ``time_gate_violations`` - run it first.)"""
    return _transactions(raw, "listing", "listtime",
                         {"numtickets": 0, "priceperticket": 0, "totalprice": 0}, mode, steps=steps)


def clean_sales(raw: DataFrame, mode: str = "strict", steps: Steps | None = None) -> DataFrame:
    """salesid not null; qtysold NULL or >= 1; NULL money -> 0; latest saletime wins."""
    qty_ok = F.col("qtysold").isNull() | (F.col("qtysold") >= 1)
    return _transactions(raw, "sales", "saletime",
                         {"commission": 0, "pricepaid": 0}, mode, extra_filter=qty_ok, steps=steps)


def observed(df: DataFrame, name: str, key: str | None = None):
    """Attach step metrics to a frame without an extra action: returns
    (frame, Observation). After the first action on the frame,
    ``obs.get`` holds rows and NULL keys."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if key:
        metrics.append(F.count(F.when(F.col(key).isNull(), 1)).alias("null_keys"))
    return df.observe(obs, *metrics), obs
