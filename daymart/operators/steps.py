"""Row counts between the steps of a cleaner, taken by the job that writes its result.

Each ``watch`` puts an observation into the plan; none is a job or a scan. Duplicates are what is kept before the
de-duplication and not after it: its partial rank drops them before the shuffle, and the two counts lie on both sides.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Steps:
    """Counts of one dataset: ``rows_in``, ``bad_keys``, ``filtered``, ``deduplicated``, ``rows_out``."""

    def __init__(self, dataset: str):
        self.dataset, self._seen = dataset, {}

    def watch(self, df: DataFrame, step: str, **flags: Column) -> DataFrame:
        """Count the rows of ``df`` under ``step`` and, for each flag, the rows where it is true."""
        seen = self._seen[step] = Observation(f"{self.dataset}-{step}-{uuid.uuid4().hex}")
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count(F.when(c, 1)).alias(n) for n, c in flags.items()])

    def report(self) -> dict:
        """After the job that wrote the dataset has ended (it waits for it otherwise)."""
        got = {step: seen.get for step, seen in self._seen.items()}
        parsed, out = got["parsed"], got["out"]
        bad = parsed.get("bad_keys", 0)
        kept = got["kept"]["rows"] if "kept" in got else parsed["rows"] - bad
        return {"dataset": self.dataset, "rows_in": parsed["rows"], "bad_keys": bad,
                "filtered": parsed["rows"] - bad - kept, "deduplicated": kept - out["rows"], "rows_out": out["rows"]}


def watch(steps: Steps | None, df: DataFrame, step: str, **flags: Column) -> DataFrame:
    return df if steps is None else steps.watch(df, step, **flags)
