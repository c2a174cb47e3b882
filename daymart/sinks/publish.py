"""Versioned warehouse with a commit log (all-or-nothing publication).

Layout under ``root``::

    tables/<table>/v=<batch>-a<attempt>-<run>/part-*.parquet   written once
    ranges/<table>/v=<batch>-a<attempt>-<run>/part-*.parquet   least and largest cluster columns of each file
    _commits/<n>.json                                          renamed into place, once

A commit lists, per table, the live version directories plus the
watermark (processed load dates) and batch receipts. Readers resolve the
highest commit. Everything is written first and checked; only then is the
next commit file written under a draft name and renamed without overwrite
(one winner if two writers race). A failure before that
step leaves the previous commit live - nothing partial is ever visible.

Dimension history is split into ``<dim>_closed`` (append-only directories)
and ``<dim>_current`` (replaced each load), so a daily load rewrites only
current rows. Facts are append-only directories, ranged and sorted by their
cluster columns; ``between`` reads only the files whose range meets a filter.
``vacuum`` removes directories that no retained commit names.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart.errors import DataContractError
from daymart.sinks.hadoop import Files
from daymart.sinks.observed import Written, write_observed

# ---- fixed values: messages ------------------------------------------------
NOT_NULL_MSG = "NOT NULL violation in {table}.{column}"
# ---- end of fixed values ---------------------------------------------------


class ConcurrentCommitError(RuntimeError):
    pass


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark, self.root)

    # ------------------------------------------------------------ commits --
    def versions(self) -> list[int]:
        """Numbers of the commits, ascending."""
        names = [name for name, _, _ in self.files.listed(f"{self.root}/_commits")]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def state(self, version: int) -> dict:
        return self.files.read_json(f"{self.root}/_commits/{version}.json")

    def latest(self) -> dict:
        found = self.versions()
        if not found:
            return {"version": 0, "tables": {}, "schemas": {}, "watermark": [], "receipts": []}
        return self.state(found[-1])

    def _create_exclusive(self, version: int, doc: dict) -> None:
        if not self.files.create_json(f"{self.root}/_commits/{version}.json", doc):
            raise ConcurrentCommitError(f"commit {version} already exists")

    # ------------------------------------------------------------- reads --
    def table(self, name: str, state: dict | None = None) -> DataFrame | None:
        state = state or self.latest()
        dirs = state["tables"].get(name)
        schema = state.get("schemas", {}).get(name)
        if dirs is None:
            return None
        if not dirs:
            return self.spark.createDataFrame([], T.StructType.fromJson(json.loads(schema)))
        df = self.spark.read.parquet(*dirs)
        return df if schema is None else df.select(*T.StructType.fromJson(json.loads(schema)).names)

    def dimension(self, name: str, state: dict | None = None) -> DataFrame | None:
        state = state or self.latest()
        closed = self.table(f"{name}_closed", state)
        current = self.table(f"{name}_current", state)
        if current is None:
            return None
        return current if closed is None else closed.unionByName(current)

    def between(self, name: str, bounds: dict, state: dict | None = None) -> DataFrame | None:
        """Rows of a clustered table with ``bounds[c][0] <= c <= bounds[c][1]`` for every column c (None: no bound).
        Only files whose written range meets all bounds are opened."""
        state = state or self.latest()
        dirs, ranges = state["tables"].get(name), state.get("ranges", {}).get(name)
        schema = T.StructType.fromJson(json.loads(state["schemas"][name])) if dirs is not None else None
        if dirs is None:
            return None
        inside, meets = F.lit(True), F.lit(True)
        for c, (low, high) in bounds.items():
            if low is not None:
                inside, meets = inside & (F.col(c) >= low), meets & (F.col(f"most_{c}") >= low)
            if high is not None:
                inside, meets = inside & (F.col(c) <= high), meets & (F.col(f"least_{c}") <= high)
        if not ranges:
            whole = self.table(name, state)
            return whole.where(inside)
        files = [r["path"] for r in self.spark.read.parquet(*ranges).where(meets).select("path").collect()]  # file metadata
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*files).where(inside)

    # ------------------------------------------------------------ writes --
    def write_version(self, name: str, df: DataFrame, tag: str, sort_cols=None, cluster: int = 0, not_null=(),
                      leave_out=()) -> Written:
        """Write-once directory for one table version. Rows, content and NULLs are observed during the write (no extra
        job); a NULL in a ``not_null`` column raises before anything can be committed.

        ``cluster``: the rows are ranged over the write tasks by ``sort_cols``, the first ``cluster`` of which are the
        cluster columns; the others (a unique key) split a range of one value that is too large for a task. Each
        file's range is written beside the table."""
        path = f"{self.root}/tables/{name}/v={tag}-{uuid.uuid4().hex[:12]}"  # a retry never meets a failed attempt
        out = df
        if cluster:
            out = out.repartitionByRange(*sort_cols)
        if sort_cols:
            out = out.sortWithinPartitions(*sort_cols)
        done = write_observed(out, path, not_null, leave_out)
        for column, n in done.nulls.items():
            if n:
                raise DataContractError(NOT_NULL_MSG.format(table=name, column=column))
        if cluster:
            columns = sort_cols[:cluster]
            self.spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("path")).agg(
                F.count(F.lit(1)).alias("rows"), *[F.min(c).alias(f"least_{c}") for c in columns],
                *[F.max(c).alias(f"most_{c}") for c in columns]).coalesce(1).write.parquet(self.ranges_of(path))
        return done

    def ranges_of(self, path: str) -> str:
        return path.replace(f"{self.root}/tables/", f"{self.root}/ranges/", 1)

    def compact(self, name: str, sort_cols, cluster: int) -> int | None:
        """Rewrite the directories of an append-only clustered table into one, ranged over all of them, as a commit of
        its own; earlier commits keep theirs. ``sources`` tells what a directory was made of. None if there is nothing
        to join. Readers then open one folder and a range scan fewer files."""
        base = self.latest()
        dirs = base["tables"].get(name, [])
        if len(dirs) < 2:
            return None
        done = self.write_version(name, self.table(name, base), f"compact-c{base['version'] + 1}", sort_cols, cluster)
        made_of = [d for path in dirs for d in base.get("sources", {}).get(path, [path])]
        return self.commit(base, {name: done.path}, {}, {}, ranges={name: self.ranges_of(done.path)},
                           sources={done.path: made_of})

    def vacuum(self, keep_seconds: float, now: float | None = None) -> list[str]:
        """Delete version directories, range tables and batch attempts that no retained commit names, and superseded
        commit files. Retained are the latest commit and all not superseded for longer than ``keep_seconds``; nothing
        changed within that time is touched, so a load in progress and readers of retained commits are safe.
        Returns what was deleted."""
        now = time.time() if now is None else now
        old = lambda ms: ms / 1000 < now - keep_seconds
        changed = {name: ms for name, _, ms in self.files.listed(f"{self.root}/_commits")}
        found, retained, gone = self.versions(), [], []
        for version, following in zip(found, [*found[1:], None]):
            if following is not None and old(changed[f"{following}.json"]):
                gone.append(f"{self.root}/_commits/{version}.json")
            else:
                retained.append(version)
        named = set()
        for version in retained:
            state = self.state(version)
            named |= {d for kind in ("tables", "ranges") for dirs in state.get(kind, {}).values() for d in dirs}
            named |= {r["attempt_root"] for r in state.get("receipts", []) if r.get("attempt_root")} if version == retained[-1] else set()
        for kind in ("tables", "ranges"):
            for table, _, _ in self.files.listed(f"{self.root}/{kind}"):
                for version, _, ms in self.files.listed(f"{self.root}/{kind}/{table}"):
                    path = f"{self.root}/{kind}/{table}/{version}"
                    if path not in named and old(ms):
                        gone.append(path)
        for batch, _, _ in self.files.listed(f"{self.root}/batches"):
            for attempt, _, ms in self.files.listed(f"{self.root}/batches/{batch}"):
                path = f"{self.root}/batches/{batch}/{attempt}"
                if path not in named and old(ms):
                    gone.append(path)
        for path in gone:  # commit files come first: no reader finds a commit whose directories are going
            self.files.delete(path)
        return gone

    def commit(self, base: dict, replace: dict, append: dict, schemas: dict,
               watermark=None, receipt=None, ranges: dict | None = None, sources: dict | None = None) -> int:
        """Create commit base.version+1: ``replace`` maps table -> new dir,
        ``append`` maps table -> added dir (kept with earlier dirs), ``ranges``
        maps clustered table -> range table of the added dir."""
        tables = dict(base["tables"])
        for name, path in replace.items():
            tables[name] = [path]
        for name, path in append.items():
            tables[name] = list(tables.get(name, [])) + ([path] if path else [])
        known = {name: ([] if name in replace else list(base.get("ranges", {}).get(name, []))) + [path]
                 for name, path in (ranges or {}).items()}
        live = {d for dirs in tables.values() for d in dirs}
        made_of = {d: held for d, held in {**base.get("sources", {}), **(sources or {})}.items() if d in live}
        doc = {
            "version": base["version"] + 1,
            "tables": tables,
            "ranges": {**base.get("ranges", {}), **known},
            "sources": made_of,
            "schemas": {**base.get("schemas", {}), **schemas},
            "watermark": sorted(set(base.get("watermark", [])) | set(watermark or [])),
            "receipts": list(base.get("receipts", [])) + ([receipt] if receipt else []),
        }
        self._create_exclusive(doc["version"], doc)
        return doc["version"]

    def receipts(self, state: dict | None = None) -> DataFrame:
        state = state or self.latest()
        from daymart.contracts import BATCH_COMMITS
        rows = [(r["batch_id"], r["input_sha"], r["output_sha"], int(r["attempt"]),
                 int(r["fence_epoch"]), r["load_date"], None) for r in state.get("receipts", [])]
        df = self.spark.createDataFrame(rows, "batch_id string, input_sha string, output_sha string, "
                                              "attempt int, fence_epoch long, load_date string, committed_at timestamp")
        return df.withColumn("load_date", F.col("load_date").cast("date")).select(*BATCH_COMMITS.names)

    def watermark(self, state: dict | None = None) -> DataFrame:
        state = state or self.latest()
        return (self.spark.createDataFrame([(d,) for d in state.get("watermark", [])], "load_date string")
                .select(F.col("load_date").cast("date").alias("load_date")))
