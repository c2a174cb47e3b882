"""Arriving batch manifests as a micro-batch stream (file source).

Each manifest names the six Bronze files of one daily batch. The stream
reads manifests with an explicit schema and hands every micro-batch to
``foreachBatch``: the manifests are validated as a DataFrame (rule
columns), ordered by (load_date, batch_id) and loaded one after another;
the first failure stops the run so a failed date blocks later dates. A
trigger takes every pending manifest, so the date order holds across all
of them even when a later day arrives first. Before a batch is loaded its
Bronze files are held against the manifest: SHA-256 and raw rows (before
cleaning and de-duplication). The cleaned datasets are written once, listed in an output manifest whose hash is the
receipt's ``output_sha``, and loaded from exactly its files with its row counts. Receipts in the warehouse make
re-delivered manifests no-ops, the stream checkpoint records which manifest files were consumed, and the batch log
keeps every batch's state: a failed date blocks later ones after a restart too.
"""

from __future__ import annotations

import datetime
import posixpath
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymart.errors import DataContractError
from daymart.sources.files import MANIFEST_SCHEMA, build_manifest, file_integrity_violations, manifest_violations


def canonical_input_sha(m: DataFrame) -> F.Column:
    """SHA-256 of the manifest's canonical JSON (sorted keys, sorted files)."""
    sorted_file = F.transform_values("files", lambda _, f: F.struct(
        f["key"].alias("key"), f["rows"].alias("rows"), f["sha256"].alias("sha256"),
        f["version_id"].alias("version_id")))
    files = F.map_from_entries(F.array_sort(F.map_entries(sorted_file)))
    doc = F.struct(F.col("batch_id"), F.col("bucket"), F.col("business_timezone"),
                   F.col("datasets"), files.alias("files"), F.col("load_date"),
                   F.col("schema_version"))
    return F.sha2(F.to_json(doc, {"ignoreNullFields": "false"}), 256)


def manifest_stream(spark: SparkSession, inbox: str) -> DataFrame:
    r = spark.readStream.schema(MANIFEST_SCHEMA).option("multiLine", True)
    return r.json(inbox).withColumn("manifest_path", F.col("_metadata.file_path"))


def verify_bronze(spark: SparkSession, batch_id: str, paths: dict, files: dict) -> None:
    """Raise unless every Bronze file has the declared SHA-256 and raw row count. Files are matched by name, which
    the manifest rules fix to ``<dataset>.csv`` (Spark spells one path in several ways)."""
    declared = spark.createDataFrame([(f"{ds}.csv", f["sha256"], f["rows"]) for ds, f in files.items()],
                                     "path string, sha256 string, rows long")
    found = build_manifest(spark, list(paths.values())) \
        .withColumn("path", F.regexp_extract("path", r"([^/]+)$", 1))
    bad = file_integrity_violations(declared, found).orderBy("path", "rule").limit(1).collect()
    if bad:
        raise DataContractError(f"Bronze file differs from batch manifest: {batch_id} {bad[0]['path']} ({bad[0]['rule']})")


def load_manifest_batch(spark: SparkSession, wh, row, paths: dict, attempt: int, mode: str, today: str | None) -> dict:
    """One batch of the stream: Bronze verified, outputs written and listed, then loaded from the list."""
    from daymart.plans.warehouse import BatchRequest, check_request, load_outputs, publish_outputs, stage_batch, with_steps

    req = BatchRequest(batch_id=row["batch_id"], load_date=row["load_date"], input_sha=row["input_sha"], attempt=attempt)
    day = today or datetime.datetime.now(datetime.timezone.utc).date().isoformat()
    state = wh.latest()
    if check_request(wh, state, req, day) == "duplicate":
        return {"status": "duplicate", "version": state["version"]}
    verify_bronze(spark, row["batch_id"], paths, row["files"])
    stage = stage_batch(spark, paths, mode)
    manifest = publish_outputs(spark, wh, stage, req)
    req = replace(req, output_sha=manifest.sha, declared_rows=manifest.rows)
    return with_steps(load_outputs(spark, wh, req, today), stage)


def process_manifests(spark: SparkSession, manifests: DataFrame, wh, bronze_root: str,
                      mode: str = "strict", today: str | None = None, key_prefix: str = "") -> list:
    """Validate and load the manifests of one micro-batch, in date order."""
    from daymart.sinks.batch_log import BatchLog

    m = manifests.withColumn("input_sha", canonical_input_sha(manifests))
    exploded = m.select("*", F.explode_outer("files").alias("dataset", "file")).drop("files")
    bad = manifest_violations(exploded, key_prefix).select("batch_id", "rule").limit(1).collect()
    if bad:
        raise DataContractError(f"invalid batch manifest: {bad[0]['batch_id']} ({bad[0]['rule']})")
    results, log = [], BatchLog(spark, wh.root)
    # manifests are metadata (one small row per batch); the data stays in Spark
    for row in m.orderBy("load_date", "batch_id").collect():
        paths = {ds: posixpath.join(bronze_root, f["key"]) for ds, f in row["files"].items()}
        def load(attempt, row=row, paths=paths):
            return load_manifest_batch(spark, wh, row, paths, attempt, mode, today)
        results.append((row["batch_id"], log.run(row["batch_id"], row["load_date"], load)["status"]))
    return results


def stream_batches(spark: SparkSession, inbox: str, wh, bronze_root: str, checkpoint: str,
                   mode: str = "strict", today: str | None = None, available_now: bool = True):
    """Consume manifests from ``inbox``; returns the per-batch statuses."""
    log = []

    def each(batch_df, _epoch):
        if batch_df.take(1):
            log.extend(process_manifests(spark, batch_df, wh, bronze_root, mode, today))

    w = manifest_stream(spark, inbox).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")).start()
    q.awaitTermination()
    return log
