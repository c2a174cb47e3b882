"""CSV/Parquet scans under explicit schema contracts (no inference).

Two modes, one set of operators:
  * ``permissive`` - lenient legacy semantics: every cell read as text,
    bad values become NULL later in the cleaners.
  * ``strict`` - exact ordered header, typed values must parse; violations
    are returned as rows (``strict_cast_violations``) and raised by callers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart import contracts
from daymart.errors import DataContractError
from daymart.functions.columns import null_if_token

TS_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


# datasets without text columns: no cell can hold a line break, so their files are split between tasks
SPLITTABLE = ("listing", "sales")


def _csv(spark: SparkSession, schema: T.StructType | None = None, multiline: bool = True):
    r = (spark.read.option("header", True).option("multiLine", multiline)
         .option("escape", '"').option("encoding", "UTF-8")
         .option("enforceSchema", False)
         .option("timestampNTZFormat", TS_FORMAT))
    return r.schema(schema) if schema is not None else r


def with_position(df: DataFrame) -> DataFrame:
    """Attach the scan position of every row so "keep the last row in file
    order" has a meaning after shuffles.

    Position = (file path, block start, id within the task). Taken directly
    at the scan, before any exchange; within one file block the id grows
    with the row order, and blocks of one file are ordered by their start.
    """
    return df.select(
        "*",
        F.struct(F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("_pos"))


def read_raw(spark: SparkSession, path, name: str, mode: str = "strict",
             bronze: bool = True, multiline: bool | None = None) -> DataFrame:
    """All-string scan of a Bronze CSV with the pandas missing-value tokens
    mapped to NULL, plus the ``_pos`` scan position.

    strict: the contract schema is applied with ``enforceSchema=false`` so
    Spark validates every file's header against it (exact names, exact
    order) and ``FAILFAST`` rejects ragged rows.
    permissive: header names are taken from the file; required columns are
    projected (missing -> error, extra -> dropped).
    multiline: cells may hold line breaks, which makes every file one task;
    by default only for datasets with text columns.
    """
    multiline = name not in SPLITTABLE if multiline is None else multiline
    schema = contracts.raw_schema(name, bronze)
    if mode == "strict":
        df = _csv(spark, schema, multiline).option("mode", "FAILFAST").csv(_paths(path))
    else:
        df = _csv(spark, None, multiline).option("mode", "PERMISSIVE").csv(_paths(path))
        df = project_required(df, schema.names)
    df = with_position(df)
    return df.select(*[null_if_token(F.col(c)).alias(c) for c in schema.names], "_pos")


def read_typed(spark: SparkSession, path, name: str, mode: str = "FAILFAST") -> DataFrame:
    """Typed scan with the stage contract (listing/sales path).

    With FAILFAST a malformed cell raises when the column is materialised;
    with PERMISSIVE it becomes NULL (counted by the cleaners' observers).
    """
    df = _csv(spark, contracts.stage_schema(name), name not in SPLITTABLE).option("mode", mode).csv(path)
    return with_position(df)


def read_dataset(spark: SparkSession, name: str, path, mode: str = "strict",
                 fmt: str = "csv") -> DataFrame:
    """Entry point for every scan: Bronze CSV (raw text) or Silver Parquet
    (typed, contract-projected)."""
    if fmt == "parquet":
        df = spark.read.schema(contracts.stage_schema(name)).parquet(*_paths(path))
        return df.select(*contracts.stage_columns(name))
    return read_raw(spark, path, name, mode)


def _paths(path):
    return list(path) if isinstance(path, (list, tuple)) else [path]


def header_violations(spark: SparkSession, path, name: str, bronze: bool = True) -> list:
    """Missing / unexpected / misordered header names of a Bronze file
    (reads the header line only)."""
    expected = contracts.raw_schema(name, bronze).names
    got = spark.read.option("header", True).csv(_paths(path)).columns
    return [] if list(got) == list(expected) else [("expected", expected), ("found", got)]


def project_required(df: DataFrame, columns) -> DataFrame:
    """Keep the required columns in contract order; missing -> error, extra -> dropped."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise DataContractError(f"Missing required columns: {missing}")
    extra = [c for c in ("_pos",) if c in df.columns]
    return df.select(*columns, *extra)


def strict_cast_violations(raw: DataFrame, name: str, key: str | None = None) -> DataFrame:
    """Rows whose text does not parse to the contract type.

    violation = raw text present AND typed value NULL. Returns
    (dataset, column, key, value) rows; the caller raises on any.
    """
    schema = contracts.stage_schema(name)
    checks = []
    for f in schema.fields:
        if f.name not in raw.columns or isinstance(f.dataType, T.StringType):
            continue
        if isinstance(f.dataType, T.TimestampNTZType):
            typed = F.try_to_timestamp(F.col(f.name), F.lit(TS_FORMAT))
        elif isinstance(f.dataType, T.BooleanType):
            typed = F.col(f.name).try_cast("boolean")
        else:
            typed = F.col(f.name).try_cast(f.dataType)
        checks.append(F.when(F.col(f.name).isNotNull() & typed.isNull(),
                             F.struct(F.lit(f.name).alias("column"),
                                      F.col(f.name).alias("value"))))
    if not checks:
        return raw.sparkSession.createDataFrame([], "dataset string, column string, key string, value string")
    key = key or contracts.KEYS[name]
    bad = raw.select(F.col(key).cast("string").alias("key"),
                     F.explode(F.filter(F.array(*checks), lambda x: x.isNotNull())).alias("v"))
    return bad.select(F.lit(name).alias("dataset"), "v.column", "key", "v.value")
