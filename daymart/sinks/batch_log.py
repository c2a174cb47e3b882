"""Durable states of batches: an append-only log beside the warehouse.

Each entry is a file of its own, ``_states/<n>.json``, written once under the next free number, so two writers cannot
overwrite each other and an entry is never changed. The latest entry of a batch is its state. A failed batch blocks
every later load date until it is committed or released, also after a restart and for streams with other checkpoints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymart.errors import DataContractError
from daymart.sinks.hadoop import Files

STATES = ("QUEUED", "RUNNING", "COMMITTED", "DUPLICATE", "FAILED", "BLOCKED")
ENTRY = "n long, batch_id string, load_date string, state string, attempt int, message string"


class BlockedError(DataContractError):
    """An earlier load date has failed and was neither committed nor released."""


class BatchLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root.rstrip('/')}/_states"
        self.files = Files(spark, self.folder)

    def append(self, batch_id: str, load_date: str, state: str, attempt: int = 1, message: str | None = None) -> int:
        if state not in STATES:
            raise ValueError(state)
        held = [int(name[:-5]) for name, _, _ in self.files.listed(self.folder) if name.endswith(".json") and name[:-5].isdigit()]
        n = max(held, default=0) + 1
        while not self.files.create_json(f"{self.folder}/{n}.json", {
                "n": n, "batch_id": batch_id, "load_date": load_date, "state": state, "attempt": attempt,
                "message": None if message is None else message[:500]}):
            n += 1  # another writer took the number
        return n

    def entries(self) -> DataFrame:
        if not self.files.listed(self.folder):
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).option("multiLine", True).option("pathGlobFilter", "[0-9]*.json").json(self.folder)

    def states(self) -> DataFrame:
        """(batch_id, load_date, state, attempt, message, failures): the latest entry of each batch."""
        return self.entries().groupBy("batch_id").agg(
            F.max_by(F.struct("load_date", "state", "attempt", "message"), "n").alias("last"),
            F.count(F.when(F.col("state") == "FAILED", 1)).alias("failures")).select("batch_id", "last.*", "failures")

    def attempt(self, batch_id: str) -> int:
        """The attempt a batch is at: one more than its failures."""
        row = self.states().where(F.col("batch_id") == batch_id).select("failures").first()
        return 1 + (row["failures"] if row else 0)

    def blocker(self, batch_id: str, load_date: str) -> str | None:
        """The failed batch of the earliest load date that blocks this one: it is of an earlier day, or of the same day
        with a smaller id."""
        earlier = (F.col("load_date") < load_date) | ((F.col("load_date") == load_date) & (F.col("batch_id") < batch_id))
        row = self.states().where((F.col("state") == "FAILED") & earlier).orderBy("load_date", "batch_id").first()
        return row["batch_id"] if row else None

    def release(self, batch_id: str) -> None:
        """Give up a failed batch: it goes back to the queue and blocks nothing."""
        row = self.states().where((F.col("batch_id") == batch_id) & (F.col("state") == "FAILED")).first()
        if row is None:
            raise DataContractError(f"{batch_id} has not failed")
        self.append(batch_id, row["load_date"], "QUEUED", row["attempt"], "released")

    def run(self, batch_id: str, load_date: str, process):
        """Run ``process(attempt)`` for a batch and log what became of it; blocked batches do not run. The result is a
        dict with ``status``."""
        other = self.blocker(batch_id, load_date)
        if other is not None:
            self.append(batch_id, load_date, "BLOCKED", message=f"blocked by {other}")
            raise BlockedError(f"{batch_id} ({load_date}) is blocked by failed batch {other}")
        attempt = self.attempt(batch_id)
        self.append(batch_id, load_date, "RUNNING", attempt)
        try:
            result = process(attempt)
        except Exception as exc:
            self.append(batch_id, load_date, "FAILED", attempt, str(exc))
            raise
        self.append(batch_id, load_date, result["status"].upper(), attempt)
        return result
