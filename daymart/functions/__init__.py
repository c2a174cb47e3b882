"""Column-expression helpers. Every helper returns a built-in Spark Column,
so all cleaning stays inside whole-stage codegen (no Python UDF)."""

from daymart.functions.columns import *  # noqa: F401,F403
