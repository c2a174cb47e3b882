"""The daily warehouse load: stage -> SCD2 dimensions -> facts -> one commit.

``load_batch`` builds every candidate frame lazily, runs the guards (each
an ordered violation DataFrame, one action per stage of the load), writes
new version directories and finally moves the commit pointer. Any failure
before the pointer move leaves the previous warehouse state untouched.
Receipts make a committed batch replay a no-op; a reused batch id with
other inputs and a stale fencing epoch are rejected.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace as changed
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymart import contracts
from daymart.errors import DataContractError, first_violation
from daymart.functions.columns import load_date_rules
from daymart.operators import facts, scd2
from daymart.operators.steps import Steps
from daymart.sinks.outputs import ROW_MISMATCH, Outputs
from daymart.sinks.publish import NOT_NULL_MSG, Warehouse  # noqa: F401
from daymart.sources.files import BATCH_ID_PATTERN, SHA256_PATTERN

# ---- fixed values: loader messages ----------------------------------------
MISSING_REFS = "Missing dimension references: sales={sales}, listings={listings}"
STAGE_FACT_KEY = "stage.{table} requires unique non-null {key}"
REUSED_BATCH = "Committed batch ID reused with different inputs"
BAD_IDENTITY = "Invalid batch request identity"
STALE_EPOCH = "Stale warehouse fencing epoch"
# ---- end of fixed values --------------------------------------------------

FACT_IDS = {"sales": "salesid", "listing": "listid"}
ROLE_COLUMNS = {"sales": ["eventid", "sellerid", "buyerid"], "listing": ["eventid", "sellerid"]}
DIMS = {"users": ("user_key", contracts.USER_ATTRS), "event": ("event_key", contracts.EVENT_ATTRS)}


@dataclass
class BatchRequest:
    batch_id: str
    load_date: str
    input_sha: str = ""
    output_sha: str = ""
    attempt: int = 1
    fence_epoch: int = 1
    declared_rows: dict = field(default_factory=dict)
    manifest_sha: str = ""  # of the output manifest; filled in by the load
    attempt_root: str = ""

    def receipt(self) -> dict:
        """``output_sha``: what the caller declared, else the output manifest's hash."""
        return {"batch_id": self.batch_id, "input_sha": self.input_sha, "output_sha": self.output_sha or self.manifest_sha,
                "manifest_sha": self.manifest_sha, "attempt": self.attempt, "fence_epoch": self.fence_epoch,
                "load_date": self.load_date, "attempt_root": self.attempt_root}


def run_concurrently(tasks: dict) -> dict:
    """Run independent Spark jobs from several driver threads at once (the
    scheduler interleaves their tasks; results keyed like ``tasks``)."""
    from concurrent.futures import ThreadPoolExecutor
    if len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(8, len(tasks))) as pool:
        futures = {k: pool.submit(f) for k, f in tasks.items()}
        return {k: fut.result() for k, fut in futures.items()}


def _empty_dim(spark, name):
    return spark.createDataFrame([], contracts.dim_schema(name))


def _conform_dim(df: DataFrame, name: str) -> DataFrame:
    schema = contracts.dim_schema(name)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _raise_first(violations: DataFrame, key_of) -> None:
    row = first_violation(violations)
    if row is not None:
        msg = scd2.GUARD_MESSAGES[row["rule"]].format(dataset=row["dataset"], key=key_of(row["dataset"]))
        raise DataContractError(f"{msg} (first: {row['key']})")


def check_request(wh: Warehouse, state: dict, req: BatchRequest, today: str) -> str | None:
    """Identity / receipt / epoch / load-date rules. Returns 'duplicate' for a no-op."""
    shas = [s for s in (req.input_sha, req.output_sha) if s]
    if not (re.fullmatch(BATCH_ID_PATTERN, req.batch_id or "") and req.attempt >= 1 and req.fence_epoch >= 1
            and all(re.fullmatch(SHA256_PATTERN, s) for s in shas)):
        raise DataContractError(f"{BAD_IDENTITY}: {req.batch_id!r}")
    for r in state.get("receipts", []):
        if r["batch_id"] == req.batch_id:
            if r["input_sha"] != req.input_sha:
                raise DataContractError(REUSED_BATCH)
            return "duplicate"
    hi = max([int(r["fence_epoch"]) for r in state.get("receipts", [])] or [0])
    if req.fence_epoch < hi:
        raise DataContractError(STALE_EPOCH)
    bad = wh.spark.range(1).select(load_date_rules(F.lit(req.load_date), today).alias("r")).first()["r"]
    if bad is not None:
        raise DataContractError(f"{scd2.GUARD_MESSAGES['load_date']} ({bad})")
    return None


class _Trace:
    """Step timings when DAYMART_TRACE is set (stderr)."""

    def __init__(self):
        import os
        import time
        self.on = bool(os.environ.get("DAYMART_TRACE"))
        self.time = time.perf_counter
        self.t = self.time()

    def __call__(self, step: str):
        if self.on:
            import sys
            now = self.time()
            print(f"[daymart] {step}: {now - self.t:.2f}s", file=sys.stderr)
            self.t = now


def reconcile(found: dict, declared: dict) -> None:
    """Raise unless every declared dataset has exactly the declared rows."""
    for n, rows in declared.items():
        if found.get(n) != rows:
            raise DataContractError(f"{ROW_MISMATCH}: {n}")


def load_outputs(spark: SparkSession, wh: Warehouse, req: BatchRequest, today: str | None = None,
                 hot_threshold: int | None = 1_000_000) -> dict:
    """Load the committed output manifest of a batch attempt that another job has written: its files are checked
    against the list, their rows against the manifest's, and the request's ``output_sha`` against its hash."""
    import datetime as _dt

    today = today or _dt.datetime.now(_dt.timezone.utc).date().isoformat()
    state = wh.latest()
    if check_request(wh, state, req, today) == "duplicate":
        return {"status": "duplicate", "version": state["version"]}
    store = Outputs(spark, wh.root)
    manifest = store.manifest(req.batch_id, req.attempt)
    if req.output_sha and req.output_sha != manifest.sha:
        raise DataContractError(f"{BAD_IDENTITY}: output manifest of {req.batch_id!r}")
    stage = store.stage(manifest)
    declared = {**manifest.rows, **req.declared_rows}
    req = changed(req, declared_rows=declared, manifest_sha=manifest.sha,
                  attempt_root=store.attempt_root(req.batch_id, req.attempt))
    return load_batch(spark, wh, stage, req, today, hot_threshold, materialize_stage=False)


def load_batch(spark: SparkSession, wh: Warehouse, stage: dict, req: BatchRequest,
               today: str | None = None, hot_threshold: int | None = 1_000_000,
               materialize_stage: bool = True) -> dict:
    """Load one batch of six stage frames (stage contracts) atomically.

    ``materialize_stage``: the stage frames are written once as the outputs
    of the batch attempt (the stage load), listed in one output manifest and
    read back from exactly its files; every guard, the resolution and the
    writes then read them instead of re-running the cleaners. Rows counted by
    those writes are held against the files and against ``declared_rows``
    before any dimension job. A retry of the attempt with the same rows
    reuses its outputs, other rows are refused.
    """
    import datetime as _dt

    trace = _Trace()
    today = today or _dt.datetime.now(_dt.timezone.utc).date().isoformat()
    state = wh.latest()
    if check_request(wh, state, req, today) == "duplicate":
        return {"status": "duplicate", "version": state["version"]}
    ld = req.load_date
    stage = {n: df for n, df in stage.items() if not n.startswith("_")}
    if materialize_stage:
        store = Outputs(spark, wh.root)
        manifest = publish_outputs(spark, wh, stage, req)
        stage = store.stage(manifest)
        req = changed(req, manifest_sha=manifest.sha, attempt_root=store.attempt_root(req.batch_id, req.attempt))
    elif req.declared_rows:
        reconcile({r["dataset"]: r["rows"] for r in reduce(DataFrame.unionByName, [
            stage[n].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("dataset"), "rows")
            for n in req.declared_rows]).collect()}, req.declared_rows)
    trace("stage")

    cached = []

    def cache(df: DataFrame) -> DataFrame:
        # reused by guards/resolution and writes; MEMORY_AND_DISK, and lost
        # blocks recompute from the staged tables
        cached.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return cached[-1]

    try:
        return _load_staged(spark, wh, state, stage, req, ld, hot_threshold, trace, cache)
    finally:
        for df in cached:
            df.unpersist()


def _load_staged(spark: SparkSession, wh: Warehouse, state: dict, stage: dict, req: BatchRequest,
                 ld: str, hot_threshold, trace, cache) -> dict:
    """Dimensions, facts and publication of one staged batch."""
    watermark = wh.watermark(state)
    dims = {n: wh.dimension(f"dim_{n}", state) or _empty_dim(spark, n) for n in DIMS}
    snaps = {n: stage[n].select(*contracts.stage_columns(n)) for n in DIMS}
    key = contracts.KEYS
    cls = {n: cache(scd2.classify(dims[n], snaps[n], key[n], DIMS[n][1])) for n in DIMS}
    guards = reduce(DataFrame.unionByName, [
        scd2.dimension_guards(dims[n], snaps[n], key[n], DIMS[n][1], ld, watermark, n, cls[n], order=i,
                              processed=ld in state.get("watermark", []))
        for i, n in enumerate(DIMS)])
    # guards of the dimensions, fact ids and hot fact keys need the stage only: their jobs run together
    early = run_concurrently({
        "guards": lambda: _raise_first(guards, lambda ds: key[ds]),
        **{f"keys_{t}": (lambda t=t, k=k: facts.stage_key_violations(stage[t], k).limit(1).count()) for t, k in FACT_IDS.items()},
        **{f"hot_{t}": (lambda t=t: facts.hot_keys_of_roles(stage[t], ROLE_COLUMNS[t], hot_threshold) if hot_threshold else {})
           for t in FACT_IDS}})
    trace("dimension guards, fact ids, hot keys")

    new_closed, new_current, new_dims = {}, {}, {}
    applied = run_concurrently({
        n: (lambda n=n, sk=sk, attrs=attrs:
            scd2.scd2_apply(dims[n], snaps[n], key[n], attrs, sk, ld, cls[n], parts=True))
        for n, (sk, attrs) in DIMS.items()})
    for n in DIMS:
        closed, current = applied[n]
        new_closed[n], new_current[n] = _conform_dim(closed, n), _conform_dim(current, n)
        old_closed = dims[n].filter(~F.col("is_current"))
        new_dims[n] = old_closed.unionByName(new_closed[n]).unionByName(new_current[n])
    post = reduce(DataFrame.unionByName, [
        scd2.validate_history(new_dims[n], key[n]).select(
            F.lit(10 + i).alias("priority"), F.lit("invalid_history").alias("rule"),
            F.lit(n).alias("dataset"), F.col(key[n]).cast("string").alias("key"))
        for i, n in enumerate(DIMS)])
    _raise_first(post, lambda ds: key[ds])
    trace("scd2 apply + history check")

    # facts: stage keys, point-in-time resolution, coverage, append
    fact_specs = {
        "sales": ("salesid", "saletime", [
            facts.Role(new_dims["event"], "eventid", "eventid", "event_key", "event_key"),
            facts.Role(new_dims["users"], "userid", "sellerid", "user_key", "seller_key"),
            facts.Role(new_dims["users"], "userid", "buyerid", "user_key", "buyer_key")],
            contracts.FACT_SALES),
        "listing": ("listid", "listtime", [
            facts.Role(new_dims["event"], "eventid", "eventid", "event_key", "event_key"),
            facts.Role(new_dims["users"], "userid", "sellerid", "user_key", "seller_key")],
            contracts.FACT_LISTING),
    }
    for t, k in FACT_IDS.items():
        if early[f"keys_{t}"]:
            raise DataContractError(STAGE_FACT_KEY.format(table=t, key=k))
    resolved, appended, bad = {}, {}, {}
    for t, (k, ts, roles, schema) in fact_specs.items():
        existing = wh.table(f"fact_{t}", state)
        existing = existing if existing is not None else spark.createDataFrame([], schema)
        newf = facts.new_facts(stage[t], existing, k)
        resolved[t] = cache(facts.resolve_roles(newf, ts, roles, row_id=k, hot=early[f"hot_{t}"]))
        bad[t] = facts.coverage_counts(resolved[t], ts, ld, [r.alias for r in roles]).select(
            F.lit(t).alias("table"), "bad")
        appended[t] = resolved[t].withColumn("load_ts", F.current_timestamp()).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    counts = {r["table"]: r["bad"] for r in bad["sales"].unionByName(bad["listing"]).collect()}
    if counts["sales"] or counts["listing"]:
        raise DataContractError(MISSING_REFS.format(sales=counts["sales"], listings=counts["listing"]))
    trace("fact resolution + coverage")
    # publish: write versions, then one exclusive commit
    # write-once directory per (batch, attempt, target commit)
    tag = f"{req.batch_id}-a{req.attempt}-c{state['version'] + 1}"
    # every version is measured while it is written; a NULL in a NOT NULL column stops the load before the commit
    replace, append, schemas, writes = {}, {}, {}, {}
    for n in DIMS:
        writes[("append", f"dim_{n}_closed")] = (new_closed[n], [key[n]])
        writes[("replace", f"dim_{n}_current")] = (new_current[n], [key[n]])
        schemas[f"dim_{n}_closed"] = schemas[f"dim_{n}_current"] = contracts.dim_schema(n).json()
    for t, (k, ts, _, schema) in fact_specs.items():
        writes[("append", f"fact_{t}")] = (appended[t], ["dateid", "eventid", k])
        schemas[f"fact_{t}"] = schema.json()
    written = run_concurrently({
        w: (lambda w=w, df=df, cols=cols: wh.write_version(
            w[1], df, tag, cols, cluster=2 if w[1].startswith("fact_") else 0, leave_out=["load_ts"],
            not_null=contracts.NOT_NULL[w[1].removesuffix("_closed").removesuffix("_current")]))
        for w, (df, cols) in writes.items()})
    affected, ranges = {}, {}
    for (kind, name), done in written.items():
        (append if kind == "append" else replace)[name] = done.path
        affected[name] = done.rows
        if name.startswith("fact_"):
            ranges[name] = wh.ranges_of(done.path)
    trace("write versions")
    version = wh.commit(state, replace, append, schemas, watermark=[ld],
                        receipt=req.receipt() if req.input_sha else None, ranges=ranges)
    trace("commit")
    # affected rows: newly closed versions, current rows, appended facts
    return {"status": "committed", "version": version, "rows": affected}


def stage_batch(spark: SparkSession, paths: dict, mode: str = "strict") -> dict:
    """Bronze CSV paths (one per dataset) -> six cleaned stage frames.

    The NULL-time gate of listing/sales runs before key filtering; in
    strict mode malformed typed cells fail the job when materialised.
    """
    from daymart.operators import clean
    from daymart.sources.scan import read_dataset

    raw = {n: read_dataset(spark, n, paths[n], mode=mode) for n in contracts.DATASETS}
    steps = {n: Steps(n) for n in contracts.DATASETS}  # filled by the jobs that write the frames
    out = {
        "category": clean.clean_category(raw["category"], steps["category"]),
        "venue": clean.clean_venue(raw["venue"], steps["venue"]),
        "users": clean.clean_users(raw["users"], steps["users"]),
        "event": clean.clean_event(raw["event"], raw["venue"], raw["category"], mode=mode, steps=steps["event"]),
    }
    for n, ts in (("listing", "listtime"), ("sales", "saletime")):
        typed = raw[n].select(clean._typed(ts, "timestamp_ntz", mode).alias(ts),
                              F.col(contracts.KEYS[n]))
        if clean.time_gate_violations(typed, ts, contracts.KEYS[n]).limit(1).count():
            raise DataContractError(f"{n}: NULL {ts} detected after CSV parsing")
    out["listing"] = clean.clean_listing(raw["listing"], mode=mode, steps=steps["listing"])
    out["sales"] = clean.clean_sales(raw["sales"], mode=mode, steps=steps["sales"])
    out["_steps"] = steps
    return out


def load_bronze(spark: SparkSession, wh: Warehouse, paths: dict, req: BatchRequest,
                mode: str = "strict", today: str | None = None) -> dict:
    """Bronze files -> stage -> warehouse commit (one call per batch). A committed load also returns, for each dataset,
    the rows read, with bad keys, filtered, de-duplicated and written (``steps``)."""
    stage = stage_batch(spark, paths, mode)
    return with_steps(load_batch(spark, wh, stage, req, today=today), stage)


def with_steps(result: dict, stage: dict) -> dict:
    if result["status"] != "committed":
        return result
    return {**result, "steps": [s.report() for s in stage["_steps"].values()]}


def publish_outputs(spark: SparkSession, wh: Warehouse, stage: dict, req: BatchRequest):
    """Write the six stage frames as the outputs of a batch attempt and commit their manifest: the first half of a
    load, for ``load_outputs`` to take up."""
    store = Outputs(spark, wh.root)
    outputs = run_concurrently({n: (lambda n=n, df=df: store.put(df, n, req.batch_id, req.attempt))
                                for n, df in stage.items() if not n.startswith("_")})
    reconcile({n: o.rows for n, o in outputs.items()}, req.declared_rows)
    return store.commit_manifest(outputs.values(), req.load_date, req.input_sha)
