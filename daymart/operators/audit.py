"""Post-load audits and integrity counters (all single aggregates)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys, count_col: str = "n") -> DataFrame:
    """GROUP BY keys HAVING COUNT(*) > 1 (partial aggregation before the shuffle)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .filter(F.col(count_col) > 1))


def null_audit(df: DataFrame, columns) -> DataFrame:
    """One row: total rows and COUNT(*) - COUNT(col) per column."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  *[(F.count(F.lit(1)) - F.count(F.col(c))).alias(f"null_{c}") for c in columns])


def dim_integrity(dim: DataFrame, key: str) -> DataFrame:
    """total, current, distinct current keys, NULL keys - one aggregate."""
    return dim.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(F.when(F.col("is_current"), 1).otherwise(0)).cast("long").alias("current_rows"),
        F.count_distinct(F.when(F.col("is_current"), F.col(key))).alias("distinct_current_keys"),
        F.count(F.when(F.col(key).isNull(), 1)).alias("null_keys"))


def current_count_violations(dim: DataFrame, key: str) -> DataFrame:
    """Keys without exactly one current version (conditional-sum invariant)."""
    return (dim.groupBy(key)
            .agg(F.sum(F.when(F.col("is_current"), 1).otherwise(0)).alias("current_rows"))
            .filter(F.col("current_rows") != 1))


def table_counts(tables: dict) -> DataFrame:
    """UNION ALL of (table_name, row_count) - one count per table, unioned
    into a single job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


# ---- fixed values: credential-like patterns (category -> regex) -----------
SECRET_PATTERNS = {
    "AWS access key": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "private key": r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
    "GitHub token": r"\b(?:gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,})\b",
    "account-specific AWS ARN": r"arn:aws[a-z-]*:[^:\s]+:[^:\s]*:(\d{12}):[^\s\"']+",
    "account-specific bucket name": r"\b[a-z0-9][a-z0-9.-]*-\d{12}\b",
    "local home path": r"/(?:Users|home)/[A-Za-z0-9_.-]+/",
}
SECRET_ASSIGNMENT = (r"^\s*(?:AWS_ACCESS_KEY_ID|AWS_SECRET_ACCESS_KEY|AWS_SESSION_TOKEN|GITHUB_TOKEN|GH_TOKEN)"
                     r"\s*=\s*[\"']?([^\s\"']+)")
PLACEHOLDER_PREFIX = "REPLACE_WITH_"
SYNTHETIC_ACCOUNT = "123456789012"
# ---- end of fixed values --------------------------------------------------


def secret_findings(docs: DataFrame, id_col: str, text_col: str,
                    allow_synthetic_account=None) -> DataFrame:
    """(id, line_no, category, matches) for credential-like text.

    Whole texts are split into lines (``posexplode``), every line is tested
    against every pattern with JVM regexes; the matched value is never
    returned, only where and what kind. ``allow_synthetic_account`` is an
    optional boolean Column (e.g. the document is a test fixture) under
    which ARNs of the documented example account are allowed.
    """
    lines = docs.select(F.col(id_col).alias("id"),
                        (allow_synthetic_account if allow_synthetic_account is not None
                         else F.lit(False)).alias("_allow"),
                        F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line"))
    hits = []
    for cat, pat in SECRET_PATTERNS.items():
        n = F.regexp_count(F.col("line"), F.lit(pat))
        if cat == "account-specific AWS ARN":
            allowed = F.regexp_count(F.col("line"), F.lit(pat.replace(r"(\d{12})", SYNTHETIC_ACCOUNT)))
            n = n - F.when(F.col("_allow"), allowed).otherwise(0)
        hits.append(F.struct(F.lit(cat).alias("category"), n.alias("matches")))
    value = F.regexp_extract(F.col("line"), SECRET_ASSIGNMENT, 1)
    assign = F.when(F.col("line").rlike(SECRET_ASSIGNMENT) & ~value.startswith(PLACEHOLDER_PREFIX), 1).otherwise(0)
    hits.append(F.struct(F.lit("credential assignment").alias("category"), assign.cast("int").alias("matches")))
    exploded = lines.select("id", (F.col("pos") + 1).alias("line_no"),
                            F.explode(F.filter(F.array(*hits), lambda h: h["matches"] > 0)).alias("h"))
    return exploded.select(F.col("id").alias(id_col), "line_no", "h.category",
                           F.col("h.matches").cast("long").alias("matches"))
