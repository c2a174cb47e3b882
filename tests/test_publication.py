"""Clustered facts, NOT NULL in the write, removal of what no commit names, durable batch states, step metrics, hot keys
of all roles and maintained views."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from batches import DAYS, batches, write_batch
from daymart import contracts
from daymart.errors import DataContractError
from daymart.operators import clean, facts
from daymart.operators.steps import Steps
from daymart.plans import views
from daymart.plans.maintained import VIEWS, MaintainedViews
from daymart.plans.warehouse import BatchRequest, load_bronze
from daymart.sinks.batch_log import BatchLog, BlockedError
from daymart.sinks.materialize import materialize, sweep
from daymart.sinks.publish import Warehouse
from daymart.sources import files
from daymart.streaming import stream_batches

TODAY = "2026-10-31"


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("wh")
    paths = {n: write_batch(str(root / "in"), n, t) for n, t in batches().items()}
    wh = Warehouse(spark, str(root / "warehouse"))
    maintained, results = MaintainedViews(wh), []
    for name in ("initial", "changed"):
        results.append(load_bronze(spark, wh, paths[name], BatchRequest(name, DAYS[name], input_sha="a" * 64), today=TODAY))
        maintained.refresh()
    return wh, paths, results, maintained


# ------------------------------------------------------------------ clustering --
def clustered(spark, wh, n=3):
    """Three commits of one table; eight files or so each, a third of the rows with one date."""
    schema = "dateid int, eventid long, salesid long"
    for k in range(n):
        df = spark.range(k * 3000, (k + 1) * 3000).selectExpr(
            "cast(case when id % 3 = 0 then 500 else id % 1000 end as int) dateid", "id % 7 eventid", "id salesid")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            done = wh.write_version("t", df, f"b{k}", ["dateid", "eventid", "salesid"], cluster=2)
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        struct = json.dumps(spark.createDataFrame([], schema).schema.jsonValue())
        wh.commit(wh.latest(), {}, {"t": done.path}, {"t": struct}, ranges={"t": wh.ranges_of(done.path)})


def test_a_range_scan_opens_only_files_that_meet_it(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    clustered(spark, wh)
    whole = wh.table("t")
    every = len(whole.inputFiles())
    assert every >= 9
    for bounds, rule in (({"dateid": (10, 12)}, "dateid between 10 and 12"), ({"dateid": (None, 5)}, "dateid <= 5"),
                         ({"dateid": (500, 500), "eventid": (3, 3)}, "dateid = 500 and eventid = 3"),
                         ({"dateid": (990, None)}, "dateid >= 990")):
        some = wh.between("t", bounds)
        assert len(some.inputFiles()) < every / 1.5
        assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.where(rule).collect()))
    assert wh.between("t", {"dateid": (2000, 3000)}).count() == 0
    assert wh.between("missing", {}) is None
    assert len(wh.between("t", {"dateid": (10, 12)}).inputFiles()) <= 6
    # the hot date lies in more than one file of a commit: its range is split
    hot = whole.where("dateid = 500").select(F.input_file_name().alias("f")).distinct().count()
    assert hot > 3


def test_loaded_facts_have_ranges(spark, loaded):
    wh, *_ = loaded
    state = wh.latest()
    assert len(state["ranges"]["fact_sales"]) == 2 and len(state["tables"]["fact_sales"]) == 2
    got = wh.between("fact_sales", {"dateid": (1827, 1827), "eventid": (11, 11)})
    assert sorted(r["salesid"] for r in got.collect()) == [100, 101, 102]
    assert wh.between("fact_sales", {"eventid": (12, None)}).count() == 0


def test_compaction_keeps_rows_and_opens_fewer_files(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    clustered(spark, wh)
    before, rows = wh.latest(), sorted(map(tuple, wh.table("t").collect()))
    many = len(wh.between("t", {"dateid": (10, 12)}).inputFiles())
    assert wh.compact("t", ["dateid", "eventid", "salesid"], 2) == 4 and wh.compact("t", ["dateid"], 1) is None
    state = wh.latest()
    assert len(state["tables"]["t"]) == len(state["ranges"]["t"]) == 1
    assert state["sources"] == {state["tables"]["t"][0]: before["tables"]["t"]}
    assert sorted(map(tuple, wh.table("t").collect())) == sorted(map(tuple, wh.table("t", before).collect())) == rows
    some = wh.between("t", {"dateid": (10, 12)})
    assert len(some.inputFiles()) < many and some.count() == sum(10 <= r[0] <= 12 for r in rows)


def test_views_do_not_count_compacted_facts_twice(spark, tmp_path):
    paths = {n: write_batch(str(tmp_path / "in"), n, t) for n, t in batches().items()}
    for refreshed in (("initial",), ("initial", "changed"), ()):
        wh = Warehouse(spark, str(tmp_path / f"wh{len(refreshed)}"))
        maintained = MaintainedViews(wh)
        for name in ("initial", "changed"):
            load_bronze(spark, wh, paths[name], BatchRequest(name, DAYS[name], input_sha="a" * 64), today=TODAY)
            if name in refreshed:
                maintained.refresh()
        wh.compact("fact_sales", ["dateid", "eventid", "salesid"], 2)
        maintained.refresh()
        got, want = maintained.view("category"), plain(wh, "category")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert maintained.refresh() == maintained.state()


# -------------------------------------------------------------------- NOT NULL --
@pytest.mark.parametrize("column", ["user_key", "userid", "effective_date", "expiry_date", "is_current"])
def test_a_null_in_a_dimension_stops_the_write(spark, tmp_path, column):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    row = spark.createDataFrame([(1, 2, "x", True)], "user_key long, userid long, username string, is_current boolean") \
        .selectExpr("*", "date'2020-01-01' effective_date", "date'9999-12-31' expiry_date").withColumn(column, F.lit(None))
    with pytest.raises(DataContractError, match=f"NOT NULL violation in dim_users_current.{column}"):
        wh.write_version("dim_users_current", row, "b", not_null=contracts.NOT_NULL["dim_users"])
    assert wh.latest()["version"] == 0


# --------------------------------------------------------------------- removal --
def test_vacuum_removes_what_no_retained_commit_names(spark, tmp_path):
    paths = {n: write_batch(str(tmp_path / "in"), n, t) for n, t in batches().items()}
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for name in ("initial", "changed"):
        load_bronze(spark, wh, paths[name], BatchRequest(name, DAYS[name], input_sha="a" * 64), today=TODAY)
    wh.write_version("fact_sales", spark.range(3), "lost")  # a load that died
    first = wh.state(1)
    assert wh.vacuum(3600) == []  # nothing is old enough
    before = {n: sorted(map(tuple, wh.dimension(n, first).collect())) for n in ("dim_users", "dim_event")}
    # the first commit is retained while its successor is young: only the lost write goes
    age = time.time() + 7200
    old = os.path.getmtime(tmp_path / "wh/_commits/2.json")
    os.utime(tmp_path / "wh/_commits/2.json", (age, age))
    gone = wh.vacuum(3600, now=age + 10)
    assert len(gone) == 1 and "lost" in gone[0]
    assert {n: sorted(map(tuple, wh.dimension(n, first).collect())) for n in before} == before
    # later it is superseded for long enough: its current versions and its commit file go
    os.utime(tmp_path / "wh/_commits/2.json", (old, old))
    gone = wh.vacuum(3600, now=age)
    assert wh.versions() == [2] and gone[0].endswith("_commits/1.json")
    assert sorted(g.split("/")[-2] for g in gone if "/tables/" in g) == ["dim_event_current", "dim_users_current"]
    assert wh.table("fact_sales").count() == 3 and wh.dimension("dim_users").count() == 3
    assert wh.between("fact_sales", {"dateid": (0, 9999)}).count() == 3


def test_sweep_removes_old_working_tables(spark):
    kept = materialize(spark.range(3), "kept")
    assert sweep(spark, 3600) == [] and kept.count() == 3
    assert len(sweep(spark, 3600, now=time.time() + 7200)) >= 1


# ---------------------------------------------------------------- batch states --
def test_log_keeps_states_and_blocks_later_dates(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path))
    assert log.states().count() == 0 and log.blocker("x", "2026-01-01") is None and log.attempt("x") == 1

    def fails(attempt):
        raise DataContractError(f"attempt {attempt}")
    assert log.run("a", "2026-01-01", lambda attempt: {"status": "committed"})["status"] == "committed"
    for _ in range(2):
        with pytest.raises(DataContractError, match="attempt"):
            log.run("b", "2026-01-02", fails)
    again = BatchLog(spark, str(tmp_path))  # a restart
    assert again.attempt("b") == 3
    with pytest.raises(BlockedError, match="c .* blocked by failed batch b"):
        again.run("c", "2026-01-03", lambda attempt: {"status": "committed"})
    again.run("z", "2026-01-01", lambda attempt: {"status": "committed"})  # an earlier day is not blocked
    assert {r["batch_id"]: r["state"] for r in again.states().collect()} == \
        {"a": "COMMITTED", "b": "FAILED", "c": "BLOCKED", "z": "COMMITTED"}
    assert again.run("b", "2026-01-02", lambda attempt: {"status": "committed", "n": attempt})["n"] == 3
    assert again.run("c", "2026-01-03", lambda attempt: {"status": "committed"})
    with pytest.raises(DataContractError, match="has not failed"):
        again.release("b")
    with pytest.raises(DataContractError):
        again.run("d", "2026-01-04", fails)
    again.release("d")
    assert again.run("e", "2026-01-05", lambda attempt: {"status": "committed"})


def test_entries_written_at_once_get_their_own_numbers(spark, tmp_path):
    from daymart.plans.warehouse import run_concurrently

    log = BatchLog(spark, str(tmp_path))
    got = run_concurrently({k: (lambda k=k: log.append(f"b{k}", "2026-01-01", "QUEUED")) for k in range(6)})
    assert sorted(got.values()) == list(range(1, 7)) and log.entries().count() == 6


def test_a_failed_date_blocks_later_ones_in_the_next_stream_run(spark, tmp_path):
    from test_streaming import _manifest

    bronze, data = str(tmp_path / "bronze"), batches()
    wh = Warehouse(spark, str(tmp_path / "wh"))

    def deliver(inbox, name, bid, day=None, change=None):
        (tmp_path / inbox).mkdir(exist_ok=True)
        paths = write_batch(os.path.join(bronze, "batches"), bid, data[name])
        doc = _manifest(bronze, bid, day or DAYS[name], paths, data[name])
        if change:
            doc["files"]["sales"]["rows"] += change
        (tmp_path / inbox / f"{bid}.json").write_text(json.dumps(doc))

    deliver("one", "initial", "b-initial")
    deliver("one", "changed", "b-changed", change=1)
    with pytest.raises(Exception, match="b-changed sales.csv"):
        stream_batches(spark, str(tmp_path / "one"), wh, bronze, str(tmp_path / "ckpt-one"), today=TODAY)
    assert wh.latest()["version"] == 1
    deliver("two", "changed", "b-later", day="2026-10-31")
    with pytest.raises(Exception, match="b-later .* is blocked by failed batch b-changed"):
        stream_batches(spark, str(tmp_path / "two"), wh, bronze, str(tmp_path / "ckpt-two"), today=TODAY)
    assert wh.latest()["version"] == 1
    states = {r["batch_id"]: (r["state"], r["failures"]) for r in BatchLog(spark, wh.root).states().collect()}
    assert states == {"b-initial": ("COMMITTED", 0), "b-changed": ("FAILED", 1), "b-later": ("BLOCKED", 0)}
    # the delivery is mended and the stream is started again where it stopped
    deliver("one", "changed", "b-changed")
    log = stream_batches(spark, str(tmp_path / "one"), wh, bronze, str(tmp_path / "ckpt-three"), today=TODAY)
    assert dict(log) == {"b-initial": "duplicate", "b-changed": "committed"}
    receipt = wh.latest()["receipts"][-1]
    assert receipt["attempt"] == 2 and receipt["output_sha"] not in ("", receipt["input_sha"])


# ---------------------------------------------------------------- step metrics --
def test_steps_count_without_a_job(spark, tmp_path):
    rows = [("1", "1", 5), ("x", "1", 5), ("2", "0", 5), ("1", "2", 7), (None, "1", 1), ("3", None, 2), ("3", "4", 1)]
    raw = spark.createDataFrame(rows, "salesid string, qtysold string, _pos long")
    for c in contracts.stage_columns("sales"):
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit("2026-01-01 00:00:00" if c == "saletime" else "1"))
    steps = Steps("sales")
    clean.clean_sales(raw, mode="permissive", steps=steps).write.parquet(str(tmp_path / "out"))
    assert steps.report() == {"dataset": "sales", "rows_in": 7, "bad_keys": 2, "filtered": 1, "deduplicated": 2, "rows_out": 2}
    steps = Steps("category")
    text = spark.createDataFrame([("1", "a", 0), ("1", "b", 1), ("", "c", 2)], "catid string, catgroup string, _pos long") \
        .selectExpr("*", "'n' catname", "'d' catdesc")
    clean.clean_category(text, steps).collect()
    assert steps.report() == {"dataset": "category", "rows_in": 3, "bad_keys": 1, "filtered": 0, "deduplicated": 1, "rows_out": 1}


def test_a_load_reports_its_steps(loaded):
    *_, results, _ = loaded
    got = {s["dataset"]: (s["rows_in"], s["rows_out"]) for s in results[1]["steps"]}
    assert got == {"category": (1, 1), "venue": (1, 1), "users": (2, 2), "event": (1, 1), "listing": (3, 3), "sales": (3, 3)}


# -------------------------------------------------------------------- hot keys --
def test_hot_keys_of_all_roles_come_from_one_scan(spark):
    fact = spark.range(9000).selectExpr("id", "case when id % 3 = 0 then 7 else id + 10 end seller", "id % 4 buyer",
                                        "cast(null as long) nobody")
    got = facts.hot_keys_of_roles(fact, ["seller", "buyer", "nobody", "id"], 1000)
    assert got == {"seller": [(7, 3)], "buyer": got["buyer"], "nobody": [], "id": []}
    assert sorted(got["buyer"]) == [(k, 3) for k in range(4)]


@pytest.mark.parametrize("threshold", [100, 10**9])
def test_roles_with_and_without_hot_keys_resolve_as_the_plain_join(spark, threshold):
    dim = spark.range(0, 3000).selectExpr("id nk", "id * 2 + 1 sk", "date'2020-01-01' effective_date", "date'2021-01-01' expiry_date") \
        .unionAll(spark.sql("select 7 nk, 99999 sk, date'2021-01-01' effective_date, date'9999-12-31' expiry_date"))
    fact = spark.range(2000).selectExpr("id", "case when id % 3 = 0 then 7 else id end seller", "id % 5 buyer",
                                        "case when id % 2 = 0 then timestamp_ntz'2020-06-01 00:00:00' else timestamp_ntz'2022-01-01 00:00:00' end ts")
    roles = [facts.Role(dim, "nk", "seller", "sk", "seller_key"), facts.Role(dim, "nk", "buyer", "sk", "buyer_key")]
    want = sorted(map(tuple, facts.resolve_roles(fact, "ts", roles).collect()), key=str)
    got = facts.resolve_roles(fact, "ts", roles, hot_threshold=threshold, row_id="id")
    assert sorted(map(tuple, got.collect()), key=str) == want and len(want) == 2000


# ---------------------------------------------------------------------- views --
def plain(wh, name):
    state = wh.latest()
    sales, event, users = wh.table("fact_sales", state), wh.dimension("dim_event", state), wh.dimension("dim_users", state)
    return {"venue": lambda: views.venue_performance(sales, event), "seller": lambda: views.seller_performance(sales, users),
            "top_events": lambda: views.top_events(sales, event), "monthly": lambda: views.monthly_sales(sales),
            "category": lambda: views.category_performance(sales, event)}[name]()


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_maintained_views_equal_full_ones_after_two_commits(loaded, name):
    wh, _, _, maintained = loaded
    got, want = maintained.view(name), plain(wh, name)
    assert got.columns == want.columns and [t for _, t in got.dtypes] == [t for _, t in want.dtypes]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert maintained.state()["version"] == 2 and maintained.state()["n"] == 2
    assert maintained.refresh() == maintained.state()  # nothing new


def test_view_parts_merge_exactly(spark):
    from daymart.plans.maintained import merged, parts, result

    rows = [("a", "x", 1, 2, "1.50", "0.10"), ("a", "x", 1, 2, "1.50", "0.10"), ("a", "x", 40_000, None, None, None),
            (None, "x", 3, 1, "2.00", "0.30"), ("b", None, 2_000_000_000_000, 5, "9.99", None)]
    df = spark.createDataFrame(rows, "catgroup string, catname string, salesid long, qtysold short, pricepaid string, commission string") \
        .withColumns({c: F.col(c).cast("decimal(8,2)") for c in ("pricepaid", "commission")})
    keys = VIEWS["category"]
    for cut in range(6):
        one, other = df.limit(cut), df.subtract(df.limit(0)) if cut == 0 else spark.createDataFrame(df.collect()[cut:], df.schema)
        if cut == 0:
            other = df
        got = result(merged(parts(one, keys), parts(other, keys), keys), "category")
        want = df.groupBy(*keys).agg(*views.measures())
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


# ---------------------------------------------------------------------- files --
def test_stores_that_only_spark_reads_give_the_same_hashes(spark, tmp_path):
    held = {"a b+c%.csv": b"x,y\r\n1,2\n\n3,\xff\x00\n" * 5000, "mark.csv": b"\xef\xbb\xbfa\n" + b"b\n" * 500,
            "no_end.csv": b"1\n\n2" * 3000, "empty.csv": b"", "random.parquet": os.urandom(300_000)}
    for name, raw in held.items():
        (tmp_path / name).write_bytes(raw)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        near = sorted(map(tuple, files.file_inventory(spark, str(tmp_path)).collect()))
        far = files.file_inventory(spark, str(tmp_path), whole_bytes=500, direct=())
        plan = far._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, far.collect())) == near and len(near) == 4  # empty files are not listed
        assert "hashpartitioning" not in plan and "Sort [" not in plan
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
