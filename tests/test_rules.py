"""Money rounding, metrics, lineage rules, ordered pending runs, typed scans,
and randomized interval histories checked against a brute-force model."""

import datetime as dt
import random

from pyspark.sql import functions as F

from daymart.functions.columns import money
from daymart.operators import clean, ledger, scd2
from daymart.sources.scan import read_typed


def test_bankers_rounding(spark):
    df = spark.createDataFrame([("10.005",), ("10.015",), (" 3.2 ",), ("1000000.00",), ("x",)], "p string")
    got = [r[0] for r in df.select(money("p")).collect()]
    assert [str(v) if v is not None else None for v in got] == ["10.00", "10.02", "3.20", None, None]


def test_observed_metrics(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    out, obs = clean.observed(df, "m_test", key="k")
    out.filter("k is not null").count()
    assert obs.get == {"rows": 3, "null_keys": 1}


def test_lineage_rules(spark):
    pre = "/w/batches/batch=b1/attempt=1/"
    rows = [(d, f"{pre}{d}/part-0.parquet", 10, "a" * 64, 1) for d in
            ("category", "venue", "users", "event", "listing")]
    rows += [("listing", f"{pre}listing/part-0.parquet", 10, "a" * 64, 1),
             ("listing", "/w/batches/batch=b2/attempt=1/x.parquet", 5, "bad", 1)]
    df = spark.createDataFrame(rows, "dataset string, path string, bytes long, sha256 string, rows long")
    rules = {r["rule"] for r in ledger.lineage_violations(df, pre, "b1").collect()}
    assert rules == {"outside_prefix", "wrong_batch", "sha256", "duplicate_object", "missing_dataset"}
    assert ledger.batch_path("/w", "b1", 1, "sales", "t-3") == "/w/batches/batch=b1/attempt=1/sales/task=t-3"


def test_run_pending_stops_at_first_failure(spark):
    led = spark.createDataFrame(
        [("b3", dt.date(2026, 10, 31), "QUEUED"), ("b1", dt.date(2026, 10, 29), "QUEUED"),
         ("b2", dt.date(2026, 10, 30), "QUEUED"), ("b0", dt.date(2026, 10, 28), "DONE")],
        "batch_id string, load_date date, state string")
    seen = []

    def process(batch_id, day):
        seen.append(batch_id)
        if batch_id == "b2":
            raise RuntimeError("boom")

    out = ledger.run_pending(led, 10, process)
    assert seen == ["b1", "b2"] and [s for _, s, _ in out] == ["COMMITTED", "FAILED"]


def test_typed_listing_scan(spark, tmp_path):
    p = tmp_path / "listing.csv"
    p.write_text("listid,sellerid,eventid,dateid,numtickets,priceperticket,totalprice,listtime\n"
                 "10,1,11,1827,1,10.00,10.00,2025-07-16 13:58:49.437077\n"
                 "11,1,11,1827,2,5.50,11.00,2025-07-16 13:58:49\n")
    rows = read_typed(spark, str(p), "listing", "FAILFAST").orderBy("listid").collect()
    assert rows[0]["listtime"] == dt.datetime(2025, 7, 16, 13, 58, 49, 437077)
    assert rows[1]["listtime"] == dt.datetime(2025, 7, 16, 13, 58, 49)
    assert str(rows[1]["priceperticket"]) == "5.50"


def _brute(versions):
    """Reference model of the history rules for one key."""
    v = sorted(versions, key=lambda r: r[0])
    rules = set()
    if sum(1 for r in v if r[2]) != 1:
        rules.add("current_count")
    for i, (eff, exp, cur) in enumerate(v):
        if eff >= exp:
            rules.add("invalid_range")
        if i + 1 < len(v):
            if exp != v[i + 1][0]:
                rules.add("gap_or_overlap")
            if cur:
                rules.add("closed_is_current")
        elif not cur or exp != dt.date(9999, 12, 31):
            rules.add("open_end")
    return rules


def test_random_histories_match_brute_force(spark):
    rnd = random.Random(7)
    base = dt.date(2026, 1, 1)
    rows, model = [], {}
    for key in range(300):
        n = rnd.randint(1, 4)
        starts = sorted(rnd.sample(range(0, 40), n))
        versions = []
        for i, s in enumerate(starts):
            eff = base + dt.timedelta(days=s)
            if i + 1 < n:
                exp = base + dt.timedelta(days=starts[i + 1] + rnd.choice([0, 0, 0, -1, 2]))
                cur = rnd.random() < 0.1
            else:
                exp = dt.date(9999, 12, 31) if rnd.random() < 0.9 else base + dt.timedelta(days=s + 1)
                cur = rnd.random() < 0.9
            versions.append((eff, exp, cur))
        model[key] = _brute(versions)
        rows += [(key, e, x, c) for e, x, c in versions]
    dim = spark.createDataFrame(rows, "userid int, effective_date date, expiry_date date, is_current boolean")
    got = {}
    for r in scd2.validate_history(dim, "userid").collect():
        got.setdefault(r["userid"], set()).add(r["rule"])
    assert {k: v for k, v in model.items() if v} == got
