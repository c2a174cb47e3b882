"""Violations are DataFrames first and exceptions second."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DataContractError(RuntimeError):
    """Raised when a guard finds a violation; nothing has been published."""


def first_violation(violations: DataFrame, order_col: str = "priority"):
    """Return the first violation row (by ``order_col``) or None.

    Only one row ever reaches the driver: Spark picks the minimum with a
    partial aggregate/top-1, so the violation set itself stays distributed.
    """
    if order_col in violations.columns:
        rows = violations.orderBy(F.col(order_col).asc()).limit(1).collect()
    else:
        rows = violations.limit(1).collect()
    return rows[0] if rows else None


def raise_if_any(violations: DataFrame, messages: dict[str, str] | None = None,
                 order_col: str = "priority") -> None:
    """Raise ``DataContractError`` for the highest-priority violation, if any."""
    row = first_violation(violations, order_col)
    if row is None:
        return
    rule = row["rule"] if "rule" in row.asDict() else "violation"
    text = (messages or {}).get(rule, rule)
    raise DataContractError(f"{text} [{rule}: {row.asDict()}]")
