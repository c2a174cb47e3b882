"""Outputs of a batch: written once, one manifest of six datasets, read back by exactly its list."""

import glob
import hashlib
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from batches import DAYS, batches, write_batch
from daymart import contracts
from daymart.errors import DataContractError
from daymart.plans.warehouse import BatchRequest, load_batch, load_outputs, publish_outputs, stage_batch
from daymart.sinks import observed
from daymart.sinks.outputs import Outputs, dataset_shas, manifest_sha, read_listed
from daymart.sinks.publish import Warehouse

TODAY = "2026-10-31"


@pytest.fixture(scope="module")
def bronze(tmp_path_factory):
    root = tmp_path_factory.mktemp("in")
    return {n: write_batch(str(root), n, t) for n, t in batches().items()}


def request(name="b-1", **kw):
    return BatchRequest(name, DAYS["initial"], input_sha="a" * 64, **kw)


def published(spark, root, bronze, which="initial", **kw):
    wh = Warehouse(spark, str(root))
    req = request(**kw)
    return wh, req, publish_outputs(spark, wh, stage_batch(spark, bronze[which]), req)


def test_content_does_not_depend_on_order_and_sees_every_cell(spark, tmp_path):
    rows = [(1, "a", None), (2, None, "b"), (2, None, "b"), (3, "", "")]
    made = {}
    for k, some in enumerate([rows, rows[::-1], rows[:-1], [*rows[:-1], (3, "", None)],
                              [(1, None, "a"), *rows[1:]], [*rows, rows[1], rows[1]]]):
        df = spark.createDataFrame(some, "k long, x string, y string").repartition(1 + k % 3)
        made[k] = observed.write_observed(df, str(tmp_path / str(k)), not_null=["x"])
    assert made[0].content == made[1].content and len({w.content for w in made.values()}) == 5
    assert made[0].rows == 4 and made[0].nulls == {"x": 2}
    empty = spark.createDataFrame([], "k long, x string, y string")
    assert observed.write_observed(empty, str(tmp_path / "empty"), not_null=["x"])[1:] != made[0][1:]
    late = spark.range(3).withColumn("at", F.current_timestamp())
    assert len({observed.write_observed(late, str(tmp_path / f"l{k}"), leave_out=["at"]).content for k in range(2)}) == 1


def test_the_same_rows_again_are_accepted_and_others_refused(spark, tmp_path, bronze):
    store = Outputs(spark, str(tmp_path / "wh"))
    stage = stage_batch(spark, bronze["changed"])
    first = store.put(stage["sales"], "sales", "b-1", 1)
    again = store.put(stage["sales"].repartition(3), "sales", "b-1", 1)
    assert again == first and first.rows == 3
    assert len(glob.glob(str(tmp_path / "wh/batches/batch=b-1/attempt=1/sales/task=*"))) == 1
    for other in (stage["sales"].limit(2), stage["sales"].withColumn("pricepaid", F.lit(1)), stage["sales"].union(stage["sales"])):
        with pytest.raises(DataContractError, match="Immutable object collision"):
            store.put(other, "sales", "b-1", 1)
    assert store.put(stage["sales"].limit(2), "sales", "b-1", 2).rows == 2  # another attempt
    assert spark.read.parquet(first.prefix).count() == 3


def test_manifest_hash_is_that_of_the_sorted_descriptors(spark, tmp_path, bronze):
    wh, req, manifest = published(spark, tmp_path / "wh", bronze, "changed")
    rows = spark.read.parquet(manifest.path).collect()
    assert {r["dataset"] for r in rows} == set(contracts.DATASETS)
    outputs = {}
    for n in contracts.DATASETS:
        own = [r for r in rows if r["dataset"] == n]
        for r in own:
            raw = open(r["path"].removeprefix("file:"), "rb").read()
            assert r["sha256"] == hashlib.sha256(raw).hexdigest() and r["bytes"] == len(raw)
        docs = sorted(json.dumps({"bytes": r["bytes"], "dataset": n, "key": "batches/" + r["path"].split("/batches/")[1],
                                  "rows": r["rows"], "sha256": r["sha256"], "task": r["task"]}, separators=(",", ":")) for r in own)
        outputs[n] = {"rows": sum(r["rows"] for r in own), "sha256": hashlib.sha256("\n".join(docs).encode()).hexdigest()}
    head = {"attempt": 1, "batch_id": "b-1", "business_timezone": "UTC", "datasets": list(contracts.DATASETS),
            "input_sha256": "a" * 64, "load_date": DAYS["initial"], "schema_version": 1, "outputs": outputs}
    want = hashlib.sha256(json.dumps(head, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert manifest.sha == want and manifest.rows == {n: o["rows"] for n, o in outputs.items()}
    assert manifest.rows["sales"] == 3


def test_all_six_or_nothing(spark, tmp_path, bronze):
    store = Outputs(spark, str(tmp_path / "wh"))
    stage = stage_batch(spark, bronze["initial"])
    outputs = {n: store.put(stage[n], n, "b-1", 1) for n in contracts.DATASETS}
    for wrong in (list(outputs.values())[:5], [*outputs.values(), outputs["sales"]],
                  [*list(outputs.values())[:5], store.put(stage["sales"], "sales", "b-1", 2)]):
        with pytest.raises(DataContractError, match="All six outputs"):
            store.commit_manifest(wrong, DAYS["initial"])
    shutil.rmtree(outputs["venue"].prefix)
    os.makedirs(outputs["venue"].prefix)
    with pytest.raises(DataContractError, match="All six outputs"):
        store.commit_manifest(outputs.values(), DAYS["initial"])
    assert not os.path.exists(tmp_path / "wh/batches/batch=b-1/attempt=1/output-manifest.json")


def test_files_that_do_not_hold_the_written_rows_are_no_output(spark, tmp_path, bronze):
    store = Outputs(spark, str(tmp_path / "wh"))
    stage = stage_batch(spark, bronze["changed"])
    outputs = {n: store.put(stage[n], n, "b-1", 1) for n in contracts.DATASETS}
    stage["sales"].limit(1).write.mode("append").parquet(outputs["sales"].prefix)  # a file too many
    with pytest.raises(DataContractError, match="COPY row count.*sales"):
        store.commit_manifest(outputs.values(), DAYS["changed"])


def test_descriptor_order_does_not_matter_and_every_field_does(spark):
    rows = [(n, "t", f"/w/batches/batch=b/attempt=1/{n}/task=t/part-{k}.parquet", 5, "a" * 64, 2) for n in ("sales", "users") for k in range(3)]
    kind = "dataset string, task string, path string, bytes long, sha256 string, rows long"
    sha = lambda some: manifest_sha(spark.createDataFrame(some, kind), {"batch_id": "b"})
    assert sha(rows) == sha(rows[::-1])
    changed = [(*rows[0][:k], v, *rows[0][k + 1:]) for k, v in ((1, "u"), (2, rows[0][2] + "x"), (3, 6), (4, "b" * 64), (5, 3))]
    assert len({sha([row, *rows[1:]]) for row in [rows[0], *changed]}) == 6
    assert {r["dataset"]: (r["files"], r["rows"]) for r in dataset_shas(spark.createDataFrame(rows, kind)).collect()} == \
        {"sales": (3, 6), "users": (3, 6)}


def test_a_retry_commits_the_same_manifest(spark, tmp_path, bronze):
    _, _, first = published(spark, tmp_path / "wh", bronze)
    _, _, again = published(spark, tmp_path / "wh", bronze)
    assert again == first
    with pytest.raises(DataContractError, match="Immutable object collision"):
        published(spark, tmp_path / "wh", bronze, "changed")


def test_load_of_published_outputs(spark, tmp_path, bronze):
    wh, req, manifest = published(spark, tmp_path / "wh", bronze)
    with pytest.raises(DataContractError, match="output manifest"):
        load_outputs(spark, wh, request(output_sha="f" * 64), TODAY)
    with pytest.raises(DataContractError, match="COPY row count.*users"):
        load_outputs(spark, wh, request(declared_rows={"users": 3}), TODAY)
    assert wh.latest()["version"] == 0
    assert load_outputs(spark, wh, request(output_sha=manifest.sha), TODAY)["status"] == "committed"
    receipt = wh.latest()["receipts"][0]
    assert receipt["output_sha"] == receipt["manifest_sha"] == manifest.sha != receipt["input_sha"]
    assert wh.receipts().first()["output_sha"] == manifest.sha
    assert load_outputs(spark, wh, request(), TODAY)["status"] == "duplicate"


def test_a_changed_row_count_in_the_manifest_stops_before_any_dimension_job(spark, tmp_path, bronze, monkeypatch):
    from daymart.operators import scd2

    wh, req, _ = published(spark, tmp_path / "wh", bronze)
    path = tmp_path / "wh/batches/batch=b-1/attempt=1/output-manifest.json"
    doc = json.loads(path.read_text())
    doc["rows"]["listing"] += 1
    path.write_text(json.dumps(doc))
    os.remove(path.parent / f".{path.name}.crc")
    monkeypatch.setattr(scd2, "classify", lambda *a, **k: pytest.fail("a dimension was read"))
    with pytest.raises(DataContractError, match="COPY row count.*listing"):
        load_outputs(spark, wh, req, TODAY)
    assert wh.latest()["version"] == 0


def test_a_load_without_a_publish_phase_has_a_manifest_too(spark, tmp_path, bronze):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    res = load_batch(spark, wh, stage_batch(spark, bronze["initial"]), request(declared_rows={"sales": 1}), TODAY)
    assert res["status"] == "committed"
    receipt = wh.latest()["receipts"][0]
    assert receipt["output_sha"] == Outputs(spark, wh.root).manifest("b-1", 1).sha
    with pytest.raises(DataContractError, match="COPY row count"):
        load_batch(spark, wh, stage_batch(spark, bronze["changed"]), BatchRequest("b-2", DAYS["changed"], declared_rows={"sales": 9}), TODAY)


def test_only_listed_files_are_read(spark, tmp_path, bronze):
    wh, req, manifest = published(spark, tmp_path / "wh", bronze, "changed")
    store = Outputs(spark, wh.root)
    entries = [(r["path"], r["bytes"]) for r in spark.read.parquet(manifest.path).where("dataset = 'sales'").collect()]
    want = sorted(r["salesid"] for r in read_listed(spark, "sales", entries).collect())
    folder = os.path.dirname(entries[0][0].removeprefix("file:"))
    shutil.copy(entries[0][0].removeprefix("file:"), f"{folder}/part-99999-added.parquet")
    assert sorted(r["salesid"] for r in store.stage(manifest)["sales"].collect()) == want == [100, 101, 102]
    with pytest.raises(DataContractError, match="listed twice"):
        read_listed(spark, "sales", [*entries, entries[0]])
    with pytest.raises(DataContractError, match="missing"):
        read_listed(spark, "sales", [*entries, (f"file:{folder}/part-88888.parquet", 5)])
    raw = open(entries[0][0].removeprefix("file:"), "rb").read()
    open(entries[0][0].removeprefix("file:"), "wb").write(raw[:-7])
    with pytest.raises(DataContractError, match=f"{len(raw) - 7} bytes, listed are {len(raw)}"):
        store.stage(manifest)


def test_descriptors_name_the_task_that_wrote_them(spark):
    from daymart.operators.ledger import lineage_violations

    pre = "/w/batches/batch=b1/attempt=1"
    rows = [(n, "t1", f"{pre}/{n}/task=t1/part-0.parquet") for n in contracts.DATASETS]
    rows[0] = (rows[0][0], "t2", rows[0][2])
    rows.append(("sales", "t9", f"{pre}/sales/task=t9/part-1.parquet"))
    rows.append(("event", "t1", f"{pre}/venue/task=t1/part-1.parquet"))
    df = spark.createDataFrame([(*r, 5, "a" * 64, 1) for r in rows],
                               "dataset string, task string, path string, bytes long, sha256 string, rows long")
    got = {(r["dataset"], r["rule"]) for r in lineage_violations(df, pre, "b1").collect()}
    assert got == {("category", "task"), ("event", "task"), ("sales", "several_tasks")}
