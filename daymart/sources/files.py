"""File-level sources: integrity inventory, batch manifests.

* ``file_inventory`` - one row per file: path, bytes, SHA-256. One sequential
  reader per file, files in parallel, no sort and no exchange.
* ``build_manifest`` - inventory joined with the per-file row counts of a
  CSV/Parquet scan (counts come from a partial aggregate, not a collect).
* ``read_manifest`` / ``manifest_violations`` - batch manifest JSON scanned
  with an explicit schema and validated by rule columns.
* ``file_integrity_violations`` - manifest entries whose file is missing,
  duplicated, or differs in size/hash/row count.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart import contracts

MANIFEST_FILE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("version_id", T.StringType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("rows", T.LongType()),
])

MANIFEST_SCHEMA = T.StructType([
    T.StructField("schema_version", T.LongType()),
    T.StructField("datasets", T.ArrayType(T.StringType())),
    T.StructField("batch_id", T.StringType()),
    T.StructField("bucket", T.StringType()),
    T.StructField("load_date", T.StringType()),
    T.StructField("business_timezone", T.StringType()),
    T.StructField("files", T.MapType(T.StringType(), MANIFEST_FILE)),
])

# ---- fixed values: identifier shapes --------------------------------------
BATCH_ID_PATTERN = r"^[a-z0-9][a-z0-9-]{0,63}$"
BUCKET_PATTERN = r"^[a-z0-9][a-z0-9.-]{2,62}$"
SHA256_PATTERN = r"^[a-f0-9]{64}$"
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
# ---- end of fixed values --------------------------------------------------


DIRECT = ("file", "s3", "gs", "abfss")  # schemes whose bytes tasks read themselves, in pieces
PIECE = 1 << 20
WHOLE_FILE_BYTES = 32 << 20  # in other stores, files up to this size are read as one row


def _hashed(rows):
    """(path, bytes, sha256) of files read in pieces, one behind another."""
    for batch in rows:
        out = []
        for path, length in zip(*(c.to_pylist() for c in batch.columns)):
            if path.startswith("file:"):
                store, name = arrow_fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
            else:
                store, name = arrow_fs.FileSystem.from_uri(quote(path, safe="/:@"))
            digest, seen = hashlib.sha256(), 0
            with store.open_input_stream(name) as source:
                while piece := source.read(PIECE):
                    digest.update(piece)
                    seen += len(piece)
            if seen != length:
                raise ValueError(f"{path}: {seen} bytes were read, {length} are listed")
            out.append((path, length, digest.hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["path", "bytes", "sha256"])


def _spelled(path):
    """One spelling of a path, whichever way Spark gave it (escapes, slashes behind the scheme)."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def _streamed_sha(rows):
    """(name, sha256) of files whose lines come one behind another in file order (name, size, line)."""
    name, digest, size, seen, held = None, None, 0, 0, b""
    bom = b"\xef\xbb\xbf"

    def ended():
        rest = size - seen - len(held)  # the reader takes off a leading mark and does not tell a last line end
        tail, digest_of = held + (b"\n" if rest in (1, 4) else b""), digest[rest in (3, 4)]
        if rest not in (0, 1, 3, 4):
            raise ValueError(f"{name}: {rest} bytes of the file were not read")
        digest_of.update(tail)
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([digest_of.hexdigest()])], names=["name", "sha256"])

    for batch in rows:
        for file, length, line in zip(*(batch.column(c).to_pylist() for c in ("name", "size", "line"))):
            if file != name:
                if name is not None:
                    yield ended()
                name, size, seen, digest = file, length, 0, (hashlib.sha256(), hashlib.sha256(bom))
            else:
                for d in digest:
                    d.update(held)
                    d.update(b"\n")
                seen += len(held) + 1
            held = line
    if name is not None:
        yield ended()


def streamed_inventory(spark: SparkSession, files: list[tuple[str, int]]) -> DataFrame:
    """(path, bytes, sha256) of large files in stores that only Spark reads: each file is one split, read as lines and
    hashed as a stream in file order. A reader session of its own keeps files whole; nothing is sorted or shuffled."""
    reader = spark.newSession()
    reader.conf.set("spark.sql.files.minPartitionNum", "1")
    reader.conf.set("spark.sql.files.maxPartitionBytes", str(max(size for _, size in files)))
    lines = reader.read.option("lineSep", "\n").text([path for path, _ in files]).select(
        _spelled(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))).alias("name"),
        F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("line"))
    sums = lines.mapInArrow(_streamed_sha, "name string, sha256 string")
    known = reader.createDataFrame(files, "path string, bytes long")  # metadata
    return F.broadcast(known.withColumn("name", _spelled(F.col("path")))).join(sums, "name").select("path", "bytes", "sha256")


def file_inventory(spark: SparkSession, paths, glob: str | None = None, max_bytes: int | None = None,
                   whole_bytes: int = WHOLE_FILE_BYTES, direct=DIRECT) -> DataFrame:
    """(path, bytes, sha256) per file, of any size. The listing is a metadata-only scan (its content column is pruned)
    whose splits are dealt by file size; its tasks read each file in pieces and hash it. In stores whose scheme is not
    in ``direct``, files up to ``whole_bytes`` are one row each and larger ones are streams of lines. With
    ``max_bytes``, larger files are rejected up front. Spark's listing leaves out empty files."""
    from daymart.errors import DataContractError
    from daymart.sinks.hadoop import Files
    paths = list(paths) if isinstance(paths, (list, tuple)) else [paths]

    def listing(some):
        r = spark.read.format("binaryFile")
        return (r.option("pathGlobFilter", glob) if glob else r).load(some)

    if max_bytes is not None:
        big = listing(paths).select("path", "length").filter(F.col("length") > max_bytes).limit(5).collect()
        if big:
            raise DataContractError(f"files too large to hash in one task: {[(b.path, b.length) for b in big]}")
    near = [p for p in paths if Files(spark, p).fs.getUri().getScheme() in direct]
    far = [p for p in paths if p not in near]
    found = []
    if near:
        found.append(listing(near).select("path", "length")
                     .mapInArrow(_hashed, "path string, bytes long, sha256 string"))
    if far:
        df = listing(far)
        found.append(df.filter(F.col("length") <= whole_bytes).select(
            "path", F.col("length").alias("bytes"), F.sha2(F.col("content"), 256).alias("sha256")))
        large = [tuple(b) for b in df.select("path", "length").filter(F.col("length") > whole_bytes).collect()]  # metadata
        if large:
            found.append(streamed_inventory(spark, large))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def row_counts(df: DataFrame) -> DataFrame:
    """(path, rows) per input file of a scan, via a partial aggregate."""
    return (df.select(F.col("_metadata.file_path").alias("path"))
            .groupBy("path").agg(F.count(F.lit(1)).alias("rows")))


def build_manifest(spark: SparkSession, paths, fmt: str = "csv") -> DataFrame:
    """Inventory + row counts: one (path, bytes, sha256, rows) row per file."""
    inv = file_inventory(spark, paths)
    if fmt == "csv":
        scan = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(paths)
    else:
        scan = spark.read.parquet(*(paths if isinstance(paths, (list, tuple)) else [paths]))
    return inv.join(row_counts(scan), "path", "left").select(
        "path", "bytes", "sha256", F.coalesce("rows", F.lit(0)).alias("rows"))


def read_manifest(spark: SparkSession, path) -> DataFrame:
    """One row per (manifest, dataset) with the manifest-level fields."""
    m = (spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True)
         .json(path).withColumn("manifest_path", F.col("_metadata.file_path")))
    return m.select("*", F.explode_outer("files").alias("dataset", "file")).drop("files")


def manifest_violations(manifests: DataFrame, key_prefix: str = "") -> DataFrame:
    """(manifest_path, batch_id, dataset, rule) for every broken rule."""
    if "manifest_path" not in manifests.columns:
        manifests = manifests.withColumn("manifest_path", F.lit(None).cast("string"))
    canonical = F.array(*[F.lit(d) for d in contracts.DATASETS])
    expected_key = F.concat(F.lit(key_prefix), F.lit("batches/"), F.col("batch_id"),
                            F.lit("/bronze/"), F.col("dataset"), F.lit(".csv"))
    per_row = [
        ("schema_version", F.col("schema_version").isNull() | (F.col("schema_version") != 1)),
        ("datasets", F.coalesce(F.col("datasets") != canonical, F.lit(True))),
        ("batch_id", ~F.coalesce(F.col("batch_id").rlike(BATCH_ID_PATTERN), F.lit(False))),
        ("bucket", ~F.coalesce(F.col("bucket").rlike(BUCKET_PATTERN), F.lit(False))),
        ("load_date", ~F.coalesce(F.col("load_date").rlike(DATE_PATTERN), F.lit(False))
         | F.try_to_date("load_date", "yyyy-MM-dd").isNull()),
        ("timezone", F.coalesce(F.col("business_timezone") != "UTC", F.lit(True))),
        ("file_key", F.coalesce(F.col("file.key") != expected_key, F.lit(True))),
        ("version_id", F.coalesce((F.col("file.version_id") == "") | (F.col("file.version_id") == "null"), F.lit(True))),
        ("sha256", ~F.coalesce(F.col("file.sha256").rlike(SHA256_PATTERN), F.lit(False))),
        ("rows", F.coalesce(F.col("file.rows") < 0, F.lit(True))),
    ]
    flagged = manifests.select(
        "manifest_path", "batch_id", "dataset",
        F.explode(F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in per_row]),
                           lambda x: x.isNotNull())).alias("rule"))
    # dataset set per manifest must be exactly the six datasets
    sets = (manifests.groupBy("manifest_path", "batch_id")
            .agg(F.array_sort(F.collect_set("dataset")).alias("ds"))
            .filter(F.col("ds") != F.array_sort(canonical))
            .select("manifest_path", "batch_id", F.lit(None).cast("string").alias("dataset"),
                    F.lit("dataset_set").alias("rule")))
    return flagged.unionByName(sets)


def file_integrity_violations(manifest_files: DataFrame, inventory: DataFrame) -> DataFrame:
    """Compare declared (path, sha256, rows[, bytes]) with the observed files.

    ``manifest_files`` needs columns path, sha256, rows (bytes optional);
    ``inventory`` is ``build_manifest`` output. Duplicated entries, missing
    files and any difference become rule rows.
    """
    dup = (manifest_files.groupBy("path").count().filter("count > 1")
           .select("path", F.lit("duplicate_entry").alias("rule")))
    j = manifest_files.alias("m").join(inventory.alias("i"), "path", "left")
    checks = [
        ("missing_file", F.col("i.sha256").isNull()),
        ("sha256", F.col("i.sha256").isNotNull() & (F.col("m.sha256") != F.col("i.sha256"))),
        ("rows", F.col("i.sha256").isNotNull() & (F.col("m.rows") != F.col("i.rows"))),
    ]
    if "bytes" in manifest_files.columns:
        checks.append(("bytes", F.col("i.sha256").isNotNull() & (F.col("m.bytes") != F.col("i.bytes"))))
    bad = j.select("path", F.explode(F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in checks]),
                                              lambda x: x.isNotNull())).alias("rule"))
    return dup.unionByName(bad)
