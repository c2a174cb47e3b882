"""Wide keys, manifest checks on the load path, identities and lineage."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from batches import DAYS, batches, write_batch
from daymart import contracts
from daymart.errors import DataContractError
from daymart.functions.columns import lenient_int
from daymart.operators import clean, ledger
from daymart.plans.warehouse import BatchRequest, check_request
from daymart.sinks.publish import Warehouse
from daymart.sources.files import MANIFEST_SCHEMA
from daymart.sources.scan import read_raw
from daymart.streaming.batches import canonical_input_sha, process_manifests


def _manifest(batch_id, day, paths, data):
    files = {t: {"key": f"batches/{batch_id}/bronze/{t}.csv", "version_id": "v1", "rows": len(data[t]),
                 "sha256": hashlib.sha256(open(p, "rb").read()).hexdigest()} for t, p in paths.items()}
    return {"schema_version": 1, "datasets": list(contracts.DATASETS), "batch_id": batch_id,
            "bucket": "test-bucket", "load_date": day, "business_timezone": "UTC", "files": files}


def _read(spark, folder, doc):
    path = folder / f"{doc['batch_id']}.json"
    path.write_text(json.dumps(doc))
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(str(path))


def test_keys_keep_all_digits_beyond_16_32_and_53_bits(spark):
    texts = ["32768", "2147483648", "9007199254740993", "-9223372036854775808", "9223372036854775808", " 7.9 ", "1e3",
             "NaN", "Infinity", "x", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(lenient_int("t", "long")).collect()]
    assert got == [32768, 2147483648, 9007199254740993, -9223372036854775808, None, 7, 1000, None, None, None, None, None]


def test_no_venue_is_lost_to_the_key_width(spark):
    raw = spark.range(32760, 32780).select(
        F.col("id").cast("string").alias("venueid"), F.lit("n").alias("venuename"), F.lit("c").alias("venuecity"),
        F.lit("TX").alias("venuestate"), F.lit("1").alias("venueseats"), F.col("id").alias("_pos"))
    assert clean.clean_venue(raw).count() == 20


def test_canonical_sha_is_that_of_the_sorted_json(spark, tmp_path):
    data = batches()["initial"]
    doc = _manifest("b-sha", DAYS["initial"], write_batch(str(tmp_path / "in"), "b-sha", data), data)
    doc["files"]["sales"]["version_id"] = None
    m = _read(spark, tmp_path, doc)
    want = hashlib.sha256(json.dumps(doc, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert m.select(canonical_input_sha(m)).first()[0] == want


def test_repeated_raw_row_loads_and_wrong_hash_or_rows_do_not(spark, tmp_path):
    bronze, data = str(tmp_path / "bronze"), batches()["initial"]
    data["sales"] = [*data["sales"], data["sales"][0]]
    paths = write_batch(os.path.join(bronze, "batches"), "b-twice", data)
    doc = _manifest("b-twice", DAYS["initial"], paths, data)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for field, value in (("sha256", "0" * 64), ("rows", len(data["sales"]) - 1)):
        bad = json.loads(json.dumps(doc))
        bad["files"]["sales"][field] = value
        with pytest.raises(DataContractError, match=f"sales.csv \\({field}\\)"):
            process_manifests(spark, _read(spark, tmp_path, bad), wh, bronze, today="2026-10-31")
    assert wh.latest()["version"] == 0
    res = process_manifests(spark, _read(spark, tmp_path, doc), wh, bronze, today="2026-10-31")
    assert res == [("b-twice", "committed")]


@pytest.mark.parametrize("change", [{"batch_id": "Bad ID!"}, {"input_sha": "zz"}, {"attempt": 0}, {"fence_epoch": 0}])
def test_request_identity(spark, tmp_path, change):
    req = BatchRequest(**({"batch_id": "b-1", "load_date": DAYS["initial"]} | change))
    with pytest.raises(DataContractError, match="identity"):
        check_request(Warehouse(spark, str(tmp_path)), {}, req, "2026-10-31")


def test_lineage_rejects_steps_upwards_other_files_and_empty_ones(spark):
    pre = "/w/batches/batch=b1/attempt=1/"
    rows = [("sales", f"{pre}../x.parquet", 5), ("users", f"{pre}users/x.txt", 5), ("event", f"{pre}event/x.parquet", 0)]
    df = spark.createDataFrame([(*r, "a" * 64, 1) for r in rows],
                               "dataset string, path string, bytes long, sha256 string, rows long")
    got = {(r["dataset"], r["rule"]) for r in ledger.lineage_violations(df, pre, "b1").where("path is not null").collect()}
    assert got == {("sales", "path"), ("users", "path"), ("event", "size")}


def test_transaction_files_are_split(spark, tmp_path):
    names = contracts.raw_schema("sales").names
    path = tmp_path / "sales.csv"
    path.write_text(",".join(names) + "\n" + "1,2,3,4,5,6,7,8.00,1.00,2026-01-01 00:00:00\n" * 20000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = read_raw(spark, str(path), "sales")
        assert df.rdd.getNumPartitions() > 5 and df.count() == 20000
        assert read_raw(spark, str(path), "sales", multiline=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
