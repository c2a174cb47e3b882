"""Contract scans, Silver writes, output descriptors, file integrity, manifests."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from batches import batches, write_batch
from daymart.errors import DataContractError
from daymart.sinks.silver import output_descriptor, write_silver
from daymart.sources import files
from daymart.sources.scan import header_violations, read_dataset


def test_strict_scan_rejects_wrong_header(spark, tmp_path):
    p = tmp_path / "category.csv"
    p.write_text("catid,catname,catgroup,catdesc\n1,a,b,c\n")
    with pytest.raises(Exception):
        read_dataset(spark, "category", str(p), mode="strict").count()
    assert header_violations(spark, str(p), "category")
    ok = tmp_path / "ok.csv"
    ok.write_text("catid,catgroup,catname,catdesc,extra\n1,a,b,c,x\n")
    df = read_dataset(spark, "category", str(ok), mode="permissive")
    assert df.columns[:4] == ["catid", "catgroup", "catname", "catdesc"]
    missing = tmp_path / "missing.csv"
    missing.write_text("catid,catgroup\n1,a\n")
    with pytest.raises(DataContractError):
        read_dataset(spark, "category", str(missing), mode="permissive")


def test_silver_write_once_and_descriptor(spark, tmp_path):
    paths = write_batch(str(tmp_path / "in"), "b", batches()["changed"])
    from daymart.plans.warehouse import stage_batch
    stage = stage_batch(spark, paths)
    out = str(tmp_path / "silver" / "sales")
    write_silver(stage["sales"], out, "sales", num_files=2)
    with pytest.raises(Exception):
        write_silver(stage["sales"], out, "sales")  # write-once
    desc = output_descriptor(spark, out, "sales", expected_rows=3)
    assert desc.agg(F.sum("rows")).first()[0] == 3
    with pytest.raises(DataContractError):
        output_descriptor(spark, out, "sales", expected_rows=4)
    assert spark.read.parquet(out).columns == [f.name for f in
                                               __import__("daymart.contracts", fromlist=["x"]).stage_schema("sales").fields]


def test_file_integrity(spark, tmp_path):
    paths = write_batch(str(tmp_path / "in"), "b", batches()["initial"])
    inv = files.build_manifest(spark, [paths["users"], paths["sales"]])
    got = {os.path.basename(r["path"]): (r["rows"], r["sha256"]) for r in inv.collect()}
    with open(paths["users"], "rb") as f:
        assert got["users.csv"] == (2, hashlib.sha256(f.read()).hexdigest())
    declared = inv.select("path", "sha256", "rows")
    assert files.file_integrity_violations(declared, inv).count() == 0
    tampered = declared.withColumn("rows", F.col("rows") + 1).unionByName(declared.limit(1))
    rules = {r["rule"] for r in files.file_integrity_violations(tampered, inv).collect()}
    assert {"rows", "duplicate_entry"} <= rules


def test_manifest_rules(spark, tmp_path):
    good = {"schema_version": 1, "datasets": ["category", "venue", "users", "event", "listing", "sales"],
            "batch_id": "b-1", "bucket": "my-bucket", "load_date": "2026-10-29", "business_timezone": "UTC",
            "files": {t: {"key": f"batches/b-1/bronze/{t}.csv", "version_id": "v1", "sha256": "a" * 64, "rows": 1}
                      for t in ["category", "venue", "users", "event", "listing", "sales"]}}
    bad = json.loads(json.dumps(good))
    bad.update(batch_id="B_1", business_timezone="CET", load_date="2026-02-30")
    bad["files"]["sales"]["sha256"] = "xyz"
    del bad["files"]["venue"]
    (tmp_path / "good.json").write_text(json.dumps(good))
    (tmp_path / "bad.json").write_text(json.dumps(bad))
    v = files.manifest_violations(files.read_manifest(spark, str(tmp_path)))
    by_batch = {}
    for r in v.collect():
        by_batch.setdefault(r["batch_id"], set()).add(r["rule"])
    assert "b-1" not in by_batch
    assert {"batch_id", "timezone", "load_date", "sha256", "file_key", "dataset_set"} <= by_batch["B_1"]


def test_strict_cast_violation_rows(spark, tmp_path):
    from daymart.sources.scan import strict_cast_violations
    raw = spark.createDataFrame(
        [("10", "1", "11", "1827", "1", "10.00", "10.00", "2026-10-29 10:00:00.000000"),
         ("11", "x", "11", "1827", "1", "ten", "10.00", "yesterday")],
        ", ".join(f"{c} string" for c in ["listid", "sellerid", "eventid", "dateid", "numtickets",
                                          "priceperticket", "totalprice", "listtime"]))
    got = sorted((r["key"], r["column"]) for r in strict_cast_violations(raw, "listing").collect())
    assert got == [("11", "listtime"), ("11", "priceperticket"), ("11", "sellerid")]


def test_inventory_rejects_oversized_files(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text("x\n" * 100)
    with pytest.raises(DataContractError, match="too large"):
        files.file_inventory(spark, str(p), max_bytes=10)
    assert files.file_inventory(spark, str(p)).first()["bytes"] == 200
