"""Batch manifests arriving in an inbox are loaded once, in date order."""

import hashlib
import json
import os

from batches import DAYS, batches, write_batch
from daymart.sinks.publish import Warehouse
from daymart.streaming import stream_batches
from daymart import contracts


def _manifest(bronze_root, batch_id, day, paths, data):
    files = {}
    for t in contracts.DATASETS:
        key = os.path.relpath(paths[t], bronze_root)
        with open(paths[t], "rb") as f:
            sha = hashlib.sha256(f.read()).hexdigest()
        files[t] = {"key": key, "version_id": "v1", "sha256": sha, "rows": len(data[t])}
    return {"schema_version": 1, "datasets": list(contracts.DATASETS), "batch_id": batch_id,
            "bucket": "test-bucket", "load_date": day, "business_timezone": "UTC", "files": files}


def test_stream_loads_in_order_and_replays_as_noop(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    data = batches()
    # deliver the later batch first: the micro-batch still loads in date order
    for name, bid in (("changed", "b-changed"), ("initial", "b-initial")):
        paths = write_batch(os.path.join(bronze, "batches"), bid, data[name])
        doc = _manifest(bronze, bid, DAYS[name], paths, data[name])
        (inbox / f"{bid}.json").write_text(json.dumps(doc))
    wh = Warehouse(spark, str(tmp_path / "wh"))
    # one trigger holding both manifests
    from daymart.streaming.batches import process_manifests
    from daymart.sources.files import MANIFEST_SCHEMA
    m = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(str(inbox))
    res = process_manifests(spark, m, wh, bronze, today="2026-10-31")
    assert [r[0] for r in res] == ["b-initial", "b-changed"]
    assert [r[1] for r in res] == ["committed", "committed"]
    assert len(wh.dimension("dim_users").collect()) == 3
    # the stream re-delivers both manifests: receipts turn them into no-ops
    log = stream_batches(spark, str(inbox), wh, bronze, str(tmp_path / "ckpt"), today="2026-10-31")
    assert sorted(s for _, s in log) == ["duplicate", "duplicate"]
    assert wh.latest()["version"] == 2


def test_stream_orders_pending_manifests_by_date(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    data = batches()
    for name, bid in (("changed", "b-changed"), ("initial", "b-initial")):  # later day arrives first
        paths = write_batch(os.path.join(bronze, "batches"), bid, data[name])
        (inbox / f"{bid}.json").write_text(json.dumps(_manifest(bronze, bid, DAYS[name], paths, data[name])))
    wh = Warehouse(spark, str(tmp_path / "wh"))
    log = stream_batches(spark, str(inbox), wh, bronze, str(tmp_path / "ckpt"), today="2026-10-31")
    assert log == [("b-initial", "committed"), ("b-changed", "committed")]
    assert len(wh.dimension("dim_users").collect()) == 3
