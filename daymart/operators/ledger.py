"""Batch table operations: registration, receipts, fencing, ordering.

The batch ledger and commit log are ordinary (small, append-only) tables;
every rule is a join or aggregate over them.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def register(ledger: DataFrame, incoming: DataFrame, key: str = "batch_id",
             fingerprint: str = "input_sha"):
    """(rows to append, conflicts). Same id + same fingerprint is a no-op;
    same id + another fingerprint is a conflict; new ids are appended."""
    new = incoming.join(ledger.select(key), key, "left_anti")
    conflicts = (incoming.alias("i").join(ledger.alias("l"), key)
                 .filter(F.col(f"i.{fingerprint}") != F.col(f"l.{fingerprint}"))
                 .select(key, F.col(f"l.{fingerprint}").alias("registered_sha"),
                         F.col(f"i.{fingerprint}").alias("incoming_sha")))
    return new, conflicts


def receipt_status(requests: DataFrame, commits: DataFrame) -> DataFrame:
    """Per request: 'new', 'duplicate' (same input committed) or 'conflict'."""
    c = commits.groupBy("batch_id").agg(F.max("input_sha").alias("_committed_sha"))
    j = requests.join(c, "batch_id", "left")
    status = (F.when(F.col("_committed_sha").isNull(), "new")
              .when(F.col("_committed_sha") == F.col("input_sha"), "duplicate")
              .otherwise("conflict"))
    return j.withColumn("status", status).drop("_committed_sha")


def stale_requests(requests: DataFrame, commits: DataFrame, epoch: str = "fence_epoch") -> DataFrame:
    """Requests whose epoch is below the highest committed epoch."""
    # the commit log's high watermark is one scalar
    hi = commits.agg(F.coalesce(F.max(epoch), F.lit(0))).first()[0]
    return requests.filter(F.col(epoch) < F.lit(hi))


def pending(ledger: DataFrame, n: int, state: str = "QUEUED") -> DataFrame:
    """First n queued batches by (load_date, batch_id) - a top-n, by design."""
    return (ledger.filter(F.col("state") == state)
            .orderBy(F.col("load_date").asc(), F.col("batch_id").asc()).limit(n))


def batch_path(root: str, batch_id: str, attempt: int | None = None,
               table: str | None = None, task: str | None = None) -> str:
    """Non-colliding namespaces: batch / attempt / table / task."""
    parts = [root, "batches", f"batch={batch_id}"]
    if attempt is not None:
        parts.append(f"attempt={int(attempt)}")
    if table is not None:
        parts.append(table)
    if task is not None:
        parts.append(f"task={task}")
    return posixpath.join(*parts)


def run_pending(ledger: DataFrame, n: int, process) -> list:
    """Process up to n queued batches in order; the first failure stops the
    run so a failed date blocks every later date. Only batch ids (metadata)
    reach the driver."""
    done = []
    for row in pending(ledger, n).select("batch_id", "load_date").collect():
        try:
            process(row["batch_id"], row["load_date"])
        except Exception as exc:  # noqa: BLE001 - report and stop in order
            done.append((row["batch_id"], "FAILED", str(exc)[:200]))
            break
        done.append((row["batch_id"], "COMMITTED", None))
    return done


def lineage_violations(descriptors: DataFrame, prefix: str, batch_id: str) -> DataFrame:
    """Output lineage rules over descriptor rows (dataset, path, bytes,
    sha256, rows): every object under the attempt prefix, no object listed
    twice, no step upwards and only Parquet files, hashes well-formed, sizes
    positive, row counts non-negative, all six datasets present. Where the
    descriptors name the ``task`` that wrote an object, the object must lie
    in that task's folder of its dataset, and a dataset must have one task:
    the task is the version that a manifest pins."""
    from daymart import contracts
    checks = [
        ("outside_prefix", ~F.col("path").startswith(prefix)),
        ("wrong_batch", ~F.col("path").contains(f"batch={batch_id}")),
        ("path", F.coalesce(F.col("path").rlike(r"(^|/)\.\.(/|$)") | ~F.col("path").endswith(".parquet"), F.lit(True))),
        ("sha256", ~F.coalesce(F.col("sha256").rlike(r"^[a-f0-9]{64}$"), F.lit(False))),
        ("size", F.coalesce(F.col("bytes") <= 0, F.lit(True)) | F.coalesce(F.col("rows") < 0, F.lit(True))),
    ]
    if "task" in descriptors.columns:
        own = F.concat(F.lit("/"), F.col("dataset"), F.lit("/task="), F.col("task"), F.lit("/"))
        checks.append(("task", ~F.coalesce(F.col("path").contains(own), F.lit(False))))
    per_row = descriptors.select(
        "dataset", "path",
        F.explode(F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in checks]),
                           lambda x: x.isNotNull())).alias("rule"))
    dups = (descriptors.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.first("dataset").alias("dataset"))
            .filter("n > 1").select("dataset", "path", F.lit("duplicate_object").alias("rule")))
    present = descriptors.select("dataset").distinct()
    expected = descriptors.sparkSession.createDataFrame([(d,) for d in contracts.DATASETS], "dataset string")
    missing = expected.join(present, "dataset", "left_anti").select(
        "dataset", F.lit(None).cast("string").alias("path"), F.lit("missing_dataset").alias("rule"))
    found = per_row.unionByName(dups).unionByName(missing)
    if "task" in descriptors.columns:
        found = found.unionByName(descriptors.groupBy("dataset").agg(F.min("task").alias("lo"), F.max("task").alias("hi"))
                                  .where("lo < hi").select("dataset", F.lit(None).cast("string").alias("path"),
                                                           F.lit("several_tasks").alias("rule")))
    return found
