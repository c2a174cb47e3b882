"""End-to-end daily loads on the five fixture batches."""

import pytest
from pyspark.sql import functions as F

from batches import DAYS, batches, write_batch
from daymart.errors import DataContractError
from daymart.plans.warehouse import BatchRequest, load_bronze
from daymart.sinks.publish import Warehouse

TODAY = "2026-10-31"


def snapshot(wh):
    st = wh.latest()
    out = {}
    for name in ("dim_users", "dim_event"):
        out[name] = sorted(tuple(r) for r in wh.dimension(name, st).collect())
    for name in ("fact_sales", "fact_listing"):
        out[name] = sorted(tuple(r) for r in wh.table(name, st).drop("load_ts").collect())
    out["watermark"] = st["watermark"]
    return out


@pytest.fixture(scope="module")
def env(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("wh")
    data = batches()
    paths = {n: write_batch(str(root / "in"), n, t) for n, t in data.items()}
    wh = Warehouse(spark, str(root / "warehouse"))
    return spark, wh, paths


def load(env, name, **kw):
    spark, wh, paths = env
    return load_bronze(spark, wh, paths[name], BatchRequest(batch_id=name.replace("_", "-"),
                                                            load_date=DAYS[name], **kw), today=TODAY)


def test_sequence(env):
    spark, wh, paths = env
    assert load(env, "initial")["status"] == "committed"
    s1 = snapshot(wh)
    assert len(s1["dim_users"]) == 2 and len(s1["dim_event"]) == 1
    assert len(s1["fact_sales"]) == 1 and len(s1["fact_listing"]) == 1

    # replay of the same day: nothing changes
    load(env, "initial")
    assert snapshot(wh) == s1

    res = load(env, "changed")
    assert res["rows"]["dim_users_closed"] == 1 and res["rows"]["dim_event_closed"] == 1
    assert res["rows"]["fact_sales"] == 2 and res["rows"]["fact_listing"] == 2
    s2 = snapshot(wh)
    assert len(s2["dim_users"]) == 3 and len(s2["dim_event"]) == 2
    st = wh.latest()
    users = wh.dimension("dim_users", st).select("user_key", "effective_date")
    events = wh.dimension("dim_event", st).select(F.col("event_key"), F.col("effective_date").alias("ev_eff"))
    sales = (wh.table("fact_sales", st)
             .join(users.withColumnRenamed("user_key", "seller_key").withColumnRenamed("effective_date", "s_eff"), "seller_key")
             .join(users.withColumnRenamed("user_key", "buyer_key").withColumnRenamed("effective_date", "b_eff"), "buyer_key")
             .join(events, "event_key"))
    got = {r["salesid"]: (r["s_eff"].day, r["ev_eff"].day, r["b_eff"].day) for r in sales.collect()}
    assert got == {100: (29, 29, 29), 101: (30, 30, 29), 102: (29, 29, 29)}
    lst = wh.table("fact_listing", st).join(
        users.withColumnRenamed("user_key", "seller_key"), "seller_key")
    assert {r["listid"]: r["effective_date"].day for r in lst.collect()} == {10: 29, 11: 29, 12: 30}
    # the NULL city is a real version
    assert wh.dimension("dim_users", st).filter("userid = 1 AND is_current").first()["city"] is None

    with pytest.raises(DataContractError, match="same-day"):
        load(env, "same_day_conflict")
    assert snapshot(wh) == s2
    with pytest.raises(DataContractError, match="Missing dimension references"):
        load(env, "missing_history")
    assert snapshot(wh) == s2
    with pytest.raises(DataContractError, match="NOT NULL"):
        load(env, "rollback_after_sales")
    assert snapshot(wh) == s2


def test_receipts_and_epochs(spark, tmp_path):
    data = batches()
    paths = write_batch(str(tmp_path / "in"), "initial", data["initial"])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    req = BatchRequest("b-1", DAYS["initial"], input_sha="a" * 64, output_sha="b" * 64, fence_epoch=5)
    assert load_bronze(spark, wh, paths, req, today=TODAY)["status"] == "committed"
    v = wh.latest()["version"]
    assert load_bronze(spark, wh, paths, req, today=TODAY)["status"] == "duplicate"
    assert wh.latest()["version"] == v
    other = BatchRequest("b-1", DAYS["initial"], input_sha="c" * 64, output_sha="b" * 64, fence_epoch=5)
    with pytest.raises(DataContractError, match="reused"):
        load_bronze(spark, wh, paths, other, today=TODAY)
    stale = BatchRequest("b-2", DAYS["initial"], input_sha="d" * 64, output_sha="b" * 64, fence_epoch=4)
    with pytest.raises(DataContractError, match="Stale"):
        load_bronze(spark, wh, paths, stale, today=TODAY)
    bad_date = BatchRequest("b-3", "2026-11-01", input_sha="e" * 64, fence_epoch=6)
    with pytest.raises(DataContractError, match="load date"):
        load_bronze(spark, wh, paths, bad_date, today=TODAY)


def test_daily_loads_on_driver_tables(spark, tmp_path):
    """The benchmark's two-day load publishes every fact exactly once."""
    import os

    import duckdb

    from daymart.plans import tpch
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test data not present")
    res = tpch.daily_loads(spark, sf, str(tmp_path / "wh"))
    assert [r["status"] for r in res] == ["committed", "committed"]
    con = duckdb.connect()
    li = f"read_parquet('{sf}/lineitem.parquet')"
    listings, sold = con.execute(
        f"SELECT count(DISTINCT (l_orderkey, l_linenumber)), "
        f"count(DISTINCT (l_orderkey, l_linenumber)) FILTER (WHERE l_linestatus = 'F') FROM {li}").fetchone()
    wh = Warehouse(spark, str(tmp_path / "wh"))
    st = wh.latest()
    assert wh.table("fact_listing", st).count() == listings
    # a key's surviving row (latest ship date) decides whether it was sold
    dedup_sold = con.execute(
        f"SELECT count(*) FROM (SELECT l_linestatus, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
        f"ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
        f"l_returnflag, l_linestatus) rn FROM {li}) WHERE rn = 1 AND l_linestatus = 'F'").fetchone()[0]
    assert wh.table("fact_sales", st).count() == dedup_sold <= sold
    assert res[1]["rows"]["fact_sales"] == dedup_sold
    assert wh.table("fact_sales", st).groupBy("salesid").count().filter("count > 1").count() == 0
