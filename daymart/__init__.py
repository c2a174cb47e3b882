"""daymart: a PySpark engine for daily-snapshot analytics warehouses.

Sub-packages:
  sources    typed CSV / Parquet scans, file inventories, batch manifests
  functions  column-expression helpers (cleaning, tokens, checks)
  operators  DataFrame -> DataFrame operators (dedup, SCD2, fact resolution, audits)
  plans      composed plans: analytical views, the daily warehouse load
  sinks      versioned publication with a commit log
  streaming  micro-batch processing of arriving batch manifests
"""

from daymart.errors import DataContractError, raise_if_any  # noqa: F401
from daymart.session import get_spark, configure  # noqa: F401

__all__ = ["DataContractError", "raise_if_any", "get_spark", "configure"]
