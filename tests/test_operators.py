"""Operator-level fixtures: cleaners, dedup, dates, calendar, keys, history."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daymart.functions.columns import load_date_rules, parse_timestamp
from daymart.operators import audit, calendar, clean, dedup, facts, keys, scd2


def _raw(spark, rows, cols):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    return df.withColumn("_pos", F.monotonically_increasing_id())


def test_category_bad_key_dropped(spark):
    raw = _raw(spark, [("1", " shows", "Rock", "Song"), ("bad", "x", "y", "z"), ("2", "sports", "Football", "Game")],
               ["catid", "catgroup", "catname", "catdesc"])
    out = {r["catid"]: r["catgroup"] for r in clean.clean_category(raw).collect()}
    assert out == {1: "SHOWS", 2: "SPORTS"}


def test_venue_seats_and_state(spark):
    raw = _raw(spark, [("1", "A", "Austin", "tx", "abc"), ("2", "B", "Miami", "fl", "100"),
                       ("3", "C", "X", "Texas", None)],
               ["venueid", "venuename", "venuecity", "venuestate", "venueseats"])
    out = {r["venueid"]: (r["venueseats"], r["venuestate"]) for r in clean.clean_venue(raw).collect()}
    assert out == {1: (0, "TX"), 2: (100, "FL"), 3: (0, "")}


def test_duplicate_lookup_does_not_multiply_events(spark):
    ev = _raw(spark, [("11", "1", "1", "1827", "Concert", "2026-10-29 18:00:00.000000")],
              ["eventid", "venueid", "catid", "dateid", "eventname", "starttime"])
    ve = _raw(spark, [("1", "Old", "Austin", "TX", "10"), ("1", "New", "Austin", "TX", "10")],
              ["venueid", "venuename", "venuecity", "venuestate", "venueseats"])
    ca = _raw(spark, [("1", "shows", "Rock", "d")], ["catid", "catgroup", "catname", "catdesc"])
    rows = clean.clean_event(ev, ve, ca).collect()
    assert len(rows) == 1 and rows[0]["venuename"] == "New"


def test_timestamp_with_microseconds(spark):
    r = spark.range(1).select(parse_timestamp(F.lit("2025-07-16 13:58:49.437077")).alias("t")).first()
    assert r["t"] == dt.datetime(2025, 7, 16, 13, 58, 49, 437077)


def test_dedup_latest_nulls_last_ties_first_in_file(spark):
    df = spark.createDataFrame(
        [(1, None, 0), (1, dt.datetime(2024, 1, 1), 1), (1, dt.datetime(2024, 1, 1), 2), (2, None, 3)],
        "k int, ts timestamp_ntz, _pos long")
    out = {r["k"]: r["_pos"] for r in dedup.dedup_latest(df, "k", "ts").collect()}
    assert out == {1: 1, 2: 3}
    assert {r["k"]: r["_pos"] for r in dedup.dedup_last(df, "k").collect()} == {1: 2, 2: 3}


BAD_DATES = [None, "", "123", "true", "2026-2-03", "2026-02-30", "2025-02-29",
             "2026-10-31T00:00:00Z", " 2026-10-31", "2026-11-01", "9999-12-30"]


def test_load_date_contract(spark):
    df = spark.createDataFrame([(d,) for d in BAD_DATES + ["2024-02-29"]], "d string")
    got = {r["d"]: r["rule"] for r in df.select("d", load_date_rules("d", "2026-10-31").alias("rule")).collect()}
    assert all(got[d] is not None for d in BAD_DATES)
    assert got["2024-02-29"] is None
    utc_only = spark.range(1).select(load_date_rules(F.lit("2026-10-30"), "2026-10-31", "Europe/Berlin")).first()[0]
    assert utc_only == "timezone"


def test_calendar_fixed_range(spark):
    cal = calendar.calendar(spark)
    rows = {r["dateid"]: r for r in cal.filter("dateid in (1827, 4382, 2192)").collect()}
    assert cal.count() == 2556
    assert rows[1827]["caldate"] == dt.date(2008, 1, 1) and rows[4382]["caldate"] == dt.date(2014, 12, 30)
    assert rows[2192]["caldate"] == dt.date(2008, 12, 31) and rows[2192]["week"] == 1
    again = calendar.merge_calendar(cal, calendar.calendar(spark, 4380, 4390))
    assert again.count() == 2556 + 8


def test_assign_keys_equals_global_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("nk"))
    out = keys.assign_keys(df, "nk", "sk", start=100, num_partitions=7)
    w = out.select("nk", "sk").orderBy("nk").collect()
    assert [r["sk"] for r in w] == list(range(101, 5101))


def _hist(spark, rows):
    return spark.createDataFrame(
        [(k, u, dt.date.fromisoformat(e), dt.date.fromisoformat(x), c) for k, u, e, x, c in rows],
        "user_key long, userid int, effective_date date, expiry_date date, is_current boolean")


@pytest.mark.parametrize("rows, rule", [
    ([(1, 1, "2026-10-29", "2026-10-30", False)], "open_end"),                    # no current
    ([(1, 1, "2026-10-29", "9999-12-31", True), (2, 1, "2026-10-30", "9999-12-31", True)], "current_count"),
    ([(1, 1, "2026-10-29", "2026-10-29", False), (2, 1, "2026-10-29", "9999-12-31", True)], "invalid_range"),
    ([(1, 1, "2026-10-29", "2026-10-30", False), (2, 1, "2026-10-31", "9999-12-31", True)], "gap_or_overlap"),
    ([(1, 1, "2026-10-29", "2026-11-02", False), (2, 1, "2026-10-31", "9999-12-31", True)], "gap_or_overlap"),
])
def test_history_rules(spark, rows, rule):
    got = {r["rule"] for r in scd2.validate_history(_hist(spark, rows), "userid").collect()}
    assert rule in got


def test_overlap_window_matches_pairs(spark):
    h = _hist(spark, [(1, 1, "2026-10-01", "2026-10-20", False), (2, 1, "2026-10-10", "2026-10-12", False),
                      (3, 1, "2026-10-15", "9999-12-31", True), (4, 2, "2026-10-01", "9999-12-31", True)])
    got = sorted(r["user_key"] for r in scd2.interval_overlaps(h, "userid", "user_key").collect())
    assert got == [2, 3]


def test_scd2_apply_semantics(spark):
    snap1 = spark.createDataFrame([(1, "Austin"), (2, "Miami")], "userid int, city string")
    h = scd2.scd2_apply(scd2.empty_dim(spark, snap1, "user_key"), snap1, "userid", ["city"], "user_key", "2026-10-29")
    snap2 = spark.createDataFrame([(1, None), (3, "Boston")], "userid int, city string")  # 2 missing
    h2 = scd2.scd2_apply(h, snap2, "userid", ["city"], "user_key", "2026-10-30")
    rows = sorted((r["user_key"], r["userid"], r["city"], str(r["expiry_date"]), r["is_current"]) for r in h2.collect())
    assert rows == [(1, 1, "Austin", "2026-10-30", False), (2, 2, "Miami", "9999-12-31", True),
                    (3, 1, None, "9999-12-31", True), (4, 3, "Boston", "9999-12-31", True)]
    assert scd2.validate_history(h2, "userid").count() == 0
    # unchanged replay on the same day is a no-op
    wm = spark.createDataFrame([(dt.date(2026, 10, 29),), (dt.date(2026, 10, 30),)], "load_date date")
    assert scd2.dimension_guards(h2, snap2, "userid", ["city"], "2026-10-30", wm, "users").count() == 0
    changed = spark.createDataFrame([(1, "Conflict City")], "userid int, city string")
    g = scd2.dimension_guards(h2, changed, "userid", ["city"], "2026-10-30", wm, "users").collect()
    assert [r["rule"] for r in g] == ["same_day_changed"]
    early = scd2.dimension_guards(h2, snap2, "userid", ["city"], "2026-10-29", wm, "users").collect()
    assert {r["rule"] for r in early} == {"out_of_order"}


def test_secret_findings(spark):
    text = "\n".join([
        "ok line",
        "key AKIA" + "ABCDEFGHIJKLMNOP" + " here",
        "-----BEGIN " + "RSA PRIVATE KEY-----",
        "tok gh" + "p_" + "a" * 24,
        "arn:aws:iam::" + "210987654321" + ":role/x",
        "bucket data-" + "210987654321" + " end",
        "path /home/" + "alice/x",
        "AWS_SECRET_ACCESS_KEY" + "=abc123",
        "AWS_SECRET_ACCESS_KEY" + "=REPLACE_WITH_SECRET",
    ])
    docs = spark.createDataFrame([(7, text)], "doc_id long, text string")
    got = sorted((r["line_no"], r["category"]) for r in audit.secret_findings(docs, "doc_id", "text").collect())
    cats = {c for _, c in got}
    assert cats == {"AWS access key", "private key", "GitHub token", "account-specific AWS ARN",
                    "account-specific bucket name", "local home path", "credential assignment"}
    assert (9, "credential assignment") not in got and (8, "credential assignment") in got


def test_audits(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "k int, v string")
    assert [tuple(r) for r in audit.duplicate_keys(df, "k").collect()] == [(1, 2)]
    assert tuple(audit.null_audit(df, ["v"]).first()) == (3, 1)


def test_hot_key_split_equals_plain_join(spark):
    # seller 1 holds most of the facts
    rows = [(i, 1 if i % 3 else (i % 50) + 2, dt.datetime(2026, 10, 29 + (i % 3), 12)) for i in range(3000)]
    fact = spark.createDataFrame(rows, "salesid int, sellerid int, saletime timestamp_ntz")
    dim_rows = [(1, 1, "2026-10-01", "2026-10-30", False), (2, 1, "2026-10-30", "9999-12-31", True)]
    dim_rows += [(k + 10, k, "2026-10-01", "9999-12-31", True) for k in range(2, 52)]
    dim = _hist(spark, dim_rows)
    role = [facts.Role(dim, "userid", "sellerid", "user_key", "seller_key")]
    plain = sorted(tuple(r) for r in facts.resolve_roles(fact, "saletime", role).collect())
    split = sorted(tuple(r) for r in facts.resolve_roles(fact, "saletime", role, hot_threshold=500).collect())
    assert plain == split and len(plain) == 3000
    assert facts.hot_keys(fact, "sellerid", 500).collect()[0]["_hot"] == 1


def test_hot_key_split_with_text_keys(spark):
    fact = spark.createDataFrame([(i, "u1" if i % 4 else "u2", dt.datetime(2026, 10, 29, 12)) for i in range(400)],
                                 "salesid int, sellerid string, saletime timestamp_ntz")
    dim = spark.createDataFrame([(1, "u1", dt.date(2026, 10, 1), dt.date(9999, 12, 31), True),
                                 (2, "u2", dt.date(2026, 10, 1), dt.date(9999, 12, 31), True)],
                                "user_key long, userid string, effective_date date, expiry_date date, is_current boolean")
    role = [facts.Role(dim, "userid", "sellerid", "user_key", "seller_key")]
    out = facts.resolve_roles(fact, "saletime", role, hot_threshold=100)
    assert sorted((r["seller_key"], r["n"]) for r in out.groupBy("seller_key").agg(F.count("*").alias("n")).collect()) \
        == [(1, 300), (2, 100)]


def test_hot_keys_of_another_type_keep_their_rows(spark):
    import datetime as dt
    fact = spark.createDataFrame([(i, 1.0 if i % 3 else float(i), dt.datetime(2026, 1, 2)) for i in range(1, 400)],
                                 "salesid int, sellerid double, saletime timestamp")
    dim = spark.createDataFrame([(k, k + 1000, dt.date(2026, 1, 1), dt.date(9999, 12, 31)) for k in range(1, 400)],
                                "userid int, user_key int, effective_date date, expiry_date date")
    role = [facts.Role(dim, "userid", "sellerid", "user_key", "seller_key")]
    plain = facts.resolve_roles(fact, "saletime", role, how="inner").orderBy("salesid").collect()
    salted = facts.resolve_roles(fact, "saletime", role, how="inner", hot_threshold=50).orderBy("salesid").collect()
    assert len(plain) == 399 and plain == salted


def test_sold_event_without_listing_is_reported(spark):
    from daymart.plans import views
    listing = spark.createDataFrame([(1, 1, 2)], "eventid int, listid int, numtickets int")
    sales = spark.createDataFrame([(2, 9, 3, 5.0)], "eventid int, salesid int, qtysold int, pricepaid double") \
        .selectExpr("eventid", "salesid", "qtysold", "cast(pricepaid as decimal(18,2)) as pricepaid")
    got = {r.eventid: (r.listings, r.tickets_listed, r.total_sales, r.tickets_sold)
           for r in views.listed_vs_sold(listing, sales).collect()}
    assert got == {1: (1, 2, 0, 0), 2: (0, 0, 1, 3)}


def test_commit_appears_whole_and_once(spark, tmp_path):
    from daymart.sinks.publish import ConcurrentCommitError, Warehouse
    wh = Warehouse(spark, str(tmp_path / "wh"))
    empty = wh.latest()
    assert wh.commit(empty, {}, {}, {}) == 1
    with pytest.raises(ConcurrentCommitError):
        wh.commit(empty, {}, {}, {})
    assert sorted(p.name for p in (tmp_path / "wh" / "_commits").iterdir() if p.name.endswith((".json", ".tmp"))) == ["1.json"]
    paths = [wh.write_version("t", spark.range(3), "b-a1")[0] for _ in range(2)]  # the same attempt, tried again
    assert paths[0] != paths[1] and spark.read.parquet(paths[1]).count() == 3
