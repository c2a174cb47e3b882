"""Sinks: Silver Parquet writes and the versioned, atomically committed warehouse."""

from daymart.sinks.publish import Warehouse, ConcurrentCommitError  # noqa: F401
from daymart.sinks.silver import write_silver, output_descriptor  # noqa: F401
