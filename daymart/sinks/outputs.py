"""Outputs of a batch attempt: written once, listed in one manifest, read back by exactly that list.

* ``put`` writes one dataset below ``batches/batch=<id>/attempt=<n>/<dataset>/task=<run>/`` and claims the place with
  ``result.json``. Rows and content are measured by the write. A retry with the same rows is accepted and gives the
  first output back (its own files go); other rows under the same attempt are refused.
* ``output_manifest`` gathers the descriptors of all six datasets (dataset, task, path, bytes, sha256, rows; a row for
  each file), checks lineage, that all six are there and that the files hold the measured rows, in one job, and takes
  a canonical hash over the sorted rows. All six or nothing: ``commit_manifest`` writes them as one table.
* ``read_listed`` is a scan of the manifest's files only. Presence, length and repeats are checked from file metadata
  before a file is opened, so a file that was added to or cut in the folder later never changes a result.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart import contracts
from daymart.errors import DataContractError
from daymart.operators import ledger
from daymart.sinks.hadoop import Files
from daymart.sinks.observed import write_observed
from daymart.sources.files import file_inventory

# ---- fixed values: messages ------------------------------------------------
COLLISION = "Immutable object collision"
ROW_MISMATCH = "COPY row count differs from committed output manifest"
INCOMPLETE = "All six outputs must be committed together"
CHANGED = "Listed file differs from the manifest"
# ---- end of fixed values ---------------------------------------------------

DESCRIPTOR = T.StructType([
    T.StructField("dataset", T.StringType()), T.StructField("task", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("bytes", T.LongType()), T.StructField("sha256", T.StringType()), T.StructField("rows", T.LongType())])


@dataclass(frozen=True)
class Output:
    dataset: str
    batch_id: str
    attempt: int
    task: str
    prefix: str
    rows: int
    content: str


@dataclass(frozen=True)
class Manifest:
    sha: str
    rows: dict  # dataset -> rows
    path: str  # Parquet table of descriptors


class Outputs:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark, root)

    def attempt_root(self, batch_id: str, attempt: int) -> str:
        return ledger.batch_path(self.root, batch_id, attempt)

    # --------------------------------------------------------------- write --
    def put(self, df: DataFrame, dataset: str, batch_id: str, attempt: int, num_files: int | None = None) -> Output:
        """The dataset's output of this attempt; see above for retries."""
        schema = contracts.stage_schema(dataset)
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        holder, task = ledger.batch_path(self.root, batch_id, attempt, dataset), uuid.uuid4().hex
        prefix = f"{holder}/task={task}"
        done = write_observed(rows.repartition(num_files) if num_files else rows, prefix)
        own = Output(dataset, batch_id, attempt, task, prefix, done.rows, done.content)
        if self.files.create_json(f"{holder}/result.json", asdict(own)):
            return own
        first = Output(**self.files.read_json(f"{holder}/result.json"))
        self.files.delete(prefix)
        if first.content != own.content:
            raise DataContractError(f"{COLLISION}: {dataset} of batch {batch_id}, attempt {attempt}")
        return first

    # ------------------------------------------------------------ manifest --
    def describe(self, outputs) -> DataFrame:
        """One row per written file of all outputs: bytes and hash read from storage, rows from the files' footers."""
        prefixes = [o.prefix for o in outputs]
        found = file_inventory(self.spark, prefixes, glob="*.parquet")
        # no column is asked for, so only footers are read; the files' schemas need not agree
        counts = self.spark.read.schema("_ int").parquet(*prefixes) \
            .groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"))
        which = self.spark.createDataFrame([(o.dataset, o.task) for o in outputs], "dataset string, task string")
        task = F.regexp_extract("path", r"/task=([0-9a-f]+)/", 1)
        return found.join(counts, "path", "left").withColumn("task", task).join(F.broadcast(which), "task") \
            .select("dataset", "task", "path", "bytes", "sha256", F.coalesce("rows", F.lit(0)).alias("rows"))

    def output_manifest(self, outputs, path: str, load_date: str, input_sha: str = "") -> str:
        """Write the descriptors of one attempt's outputs to ``path``; their canonical hash. Raises unless they are
        whole and the attempt's own."""
        from daymart.plans.warehouse import run_concurrently

        outputs = list(outputs)
        attempts = {(o.batch_id, o.attempt) for o in outputs}
        if len(attempts) != 1 or sorted(o.dataset for o in outputs) != sorted(contracts.DATASETS):
            raise DataContractError(INCOMPLETE)
        (batch_id, attempt), = attempts
        self.describe(outputs).repartition("dataset").write.mode("errorifexists").parquet(path)  # a row per file
        rows = self.spark.read.schema(DESCRIPTOR).parquet(path)
        place = self.files.fs.makeQualified(self.files.path(self.attempt_root(batch_id, attempt))).toString()
        declared = self.spark.createDataFrame([(o.dataset, o.rows) for o in outputs], "dataset string, declared long")
        head = {"attempt": attempt, "batch_id": batch_id, "business_timezone": "UTC", "datasets": list(contracts.DATASETS),
                "input_sha256": input_sha, "load_date": load_date, "schema_version": 1}
        found = run_concurrently({
            "fault": lambda: manifest_faults(rows, declared, place, batch_id).orderBy("rule", "dataset").limit(1).collect(),
            "sha": lambda: manifest_sha(rows, head)})
        if found["fault"]:
            rule = found["fault"][0]["rule"]
            said = ROW_MISMATCH if rule == "row_count" else INCOMPLETE if rule == "missing_dataset" else "Invalid output manifest"
            raise DataContractError(f"{said}: {found['fault'][0]['dataset']} ({rule})")
        return found["sha"]

    def commit_manifest(self, outputs, load_date: str, input_sha: str = "") -> Manifest:
        """Write the attempt's manifest: a table of descriptors, then ``output-manifest.json``, which names it and
        carries the hash. The same manifest again gives the first one back, another one is refused."""
        outputs = list(outputs)
        top = self.attempt_root(outputs[0].batch_id, outputs[0].attempt)
        path = f"{top}/output-manifest/v={uuid.uuid4().hex}"
        own = Manifest(self.output_manifest(outputs, path, load_date, input_sha), {o.dataset: o.rows for o in outputs}, path)
        if self.files.create_json(f"{top}/output-manifest.json", asdict(own)):
            return own
        first = Manifest(**self.files.read_json(f"{top}/output-manifest.json"))
        self.files.delete(path)
        if first.sha != own.sha:
            raise DataContractError(f"{COLLISION}: output manifest of batch {outputs[0].batch_id}")
        return first

    # ---------------------------------------------------------------- read --
    def manifest(self, batch_id: str, attempt: int) -> Manifest:
        return Manifest(**self.files.read_json(f"{self.attempt_root(batch_id, attempt)}/output-manifest.json"))

    def stage(self, manifest: Manifest) -> dict:
        """The six stage frames of a committed manifest, from exactly its files."""
        entries = self.spark.read.schema(DESCRIPTOR).parquet(manifest.path).collect()  # file metadata
        check_listed(self.spark, [(e["path"], e["bytes"]) for e in entries])
        found = {e["dataset"] for e in entries}
        if found != set(contracts.DATASETS):
            raise DataContractError(INCOMPLETE)
        by = {n: [e["path"] for e in entries if e["dataset"] == n] for n in contracts.DATASETS}
        return {n: listed_frame(self.spark, n, paths) for n, paths in by.items()}


def manifest_faults(descriptors: DataFrame, declared: DataFrame, prefix: str, batch_id: str) -> DataFrame:
    """(dataset, path, rule): lineage rules of every file, datasets that are missing, and ``row_count`` where the files
    of a dataset do not hold the ``declared`` rows (dataset, declared)."""
    lineage = ledger.lineage_violations(descriptors, prefix, batch_id)
    return lineage.unionByName(row_faults(descriptors, declared).select("dataset", F.lit(None).cast("string").alias("path"), "rule"))


def row_faults(descriptors: DataFrame, declared: DataFrame, by=("dataset",)) -> DataFrame:
    """(by..., rows, declared, rule) where the files' rows are not the ``declared`` ones (by..., declared)."""
    totals = descriptors.groupBy(*by).agg(F.sum("rows").alias("rows"))
    return declared.join(totals, list(by), "full").where(~F.col("rows").eqNullSafe(F.col("declared"))).select(
        *by, "rows", "declared", F.when(F.col("rows").isNull(), "missing_dataset")
        .when(F.col("declared").isNull(), "unexpected_dataset").otherwise("row_count").alias("rule"))


def descriptor_json() -> F.Column:
    """Canonical JSON of one descriptor: sorted names; the path below its batch, so a moved root keeps the hash."""
    return F.to_json(F.struct("bytes", "dataset", F.regexp_extract("path", r"(batches/batch=.*)$", 1).alias("key"), "rows",
                              "sha256", "task"))


def dataset_shas(descriptors: DataFrame, by=("dataset",)) -> DataFrame:
    """(by..., files, rows, sha): the hash over the sorted descriptors of each dataset of a batch attempt."""
    return descriptors.withColumn("_doc", descriptor_json()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"),
        F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list("_doc"))), 256).alias("sha"))


def manifest_sha(descriptors: DataFrame, head: dict) -> str:
    """SHA-256 of the canonical JSON of ``head`` with every dataset's hash."""
    shas = {r["dataset"]: {"rows": r["rows"], "sha256": r["sha"]} for r in dataset_shas(descriptors).collect()}  # six rows
    doc = json.dumps({**head, "outputs": shas}, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(doc.encode()).hexdigest()


def check_listed(spark: SparkSession, entries: list[tuple[str, int]]) -> None:
    """Raise unless every listed file is there once with the listed length; only metadata is read."""
    from pyspark.errors import AnalysisException

    paths = [p for p, _ in entries]
    if len(set(paths)) != len(paths):
        raise DataContractError(f"{CHANGED}: {next(p for p in paths if paths.count(p) > 1)} is listed twice")
    listed = spark.createDataFrame(entries, "path string, listed long")
    try:
        there = spark.read.format("binaryFile").load(paths).select("path", "length")
    except AnalysisException as exc:
        raise DataContractError(f"{CHANGED}: a file is missing ({exc.getCondition()})") from exc
    bad = listed.join(there, "path", "left").where(~F.col("length").eqNullSafe(F.col("listed"))).limit(1).collect()
    if bad:
        raise DataContractError(f"{CHANGED}: {posixpath.basename(bad[0]['path'])} has {bad[0]['length']} bytes, listed are {bad[0]['listed']}")


def listed_frame(spark: SparkSession, dataset: str, paths: list[str]) -> DataFrame:
    return spark.read.schema(contracts.stage_schema(dataset)).option("ignoreMissingFiles", False) \
        .parquet(*paths).select(*contracts.stage_columns(dataset))


def read_listed(spark: SparkSession, dataset: str, entries: list[tuple[str, int]]) -> DataFrame:
    """One dataset from a list of (path, bytes): the listed files and no others."""
    check_listed(spark, entries)
    return listed_frame(spark, dataset, [p for p, _ in entries])
