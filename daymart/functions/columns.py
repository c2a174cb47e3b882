"""Cleaning and comparison expressions shared by the cleaners and loaders."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "NULL_TOKENS", "BOOL_TOKENS", "strip", "null_if_token", "lenient_number",
    "lenient_int", "strict_int", "state_code", "bool_token", "seats",
    "parse_timestamp", "null_safe_changed", "canonical_sha256", "load_date_rules",
    "INT_RANGES", "money",
]

# ---- fixed values ---------------------------------------------------------
# Cell texts a pandas CSV reader treats as missing by default (exact match).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Boolean tokens (compared after strip + upper); anything else is unknown.
BOOL_TOKENS = {"TRUE": True, "FALSE": False, "T": True, "F": False,
               "1": True, "0": False, "YES": True, "NO": False}
# Accepted timestamp layouts of Bronze files, tried in order.
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss",
                     "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss",
                     "yyyy-MM-dd")
# ---- end of fixed values --------------------------------------------------

INT_RANGES = {
    "short": (-32768, 32767),
    "int": (-2147483648, 2147483647),
    "long": (-9223372036854775808, 9223372036854775807),
}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove leading/trailing whitespace of any kind (not only spaces)."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def null_if_token(c, tokens=NULL_TOKENS) -> Column:
    """Map the missing-value tokens to NULL (one ``In`` set lookup)."""
    c = _c(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def lenient_number(c) -> Column:
    """Trimmed text -> finite double, anything unparsable -> NULL.

    Goes through double because ``try_cast(' 1.5' as int)`` is NULL while
    the lenient cleaners accept fractional text and truncate it.
    """
    d = strip(c).try_cast(T.DoubleType())
    return F.when(F.isnan(d) | (F.abs(d) == float("inf")), F.lit(None).cast("double")).otherwise(d)


def lenient_int(c, kind: str = "int") -> Column:
    """Lenient key: trimmed number truncated toward zero; out of range -> NULL.

    Decimal, not double: keys above 2**53 keep every digit.
    """
    lo, hi = INT_RANGES[kind]
    d = strip(c).try_cast(T.DecimalType(38, 15))
    t = F.when((d > F.lit(Decimal(lo - 1))) & (d < F.lit(Decimal(hi + 1))), d)
    return t.cast("long").cast(kind)


def strict_int(c, kind: str = "int") -> Column:
    """Strict key: blank is NULL, any other text must be an integer
    (ANSI cast raises and fails the job)."""
    x = strip(c)
    return F.when(x == "", F.lit(None).cast(kind)).otherwise(x.cast(kind))


def state_code(c, invalid: str | None = None) -> Column:
    """Trim + upper; length other than 2 (missing included) -> ``invalid``."""
    x = F.upper(strip(c))
    return F.when(F.length(x) == 2, x).otherwise(F.lit(invalid).cast("string"))


def bool_token(c) -> Column:
    x = F.upper(strip(c))
    mapping = F.create_map(*[F.lit(v) for kv in BOOL_TOKENS.items() for v in kv])
    return F.try_element_at(mapping, x)


def seats(c) -> Column:
    """Missing, blank or unparsable seat count -> 0."""
    return F.coalesce(lenient_int(c, "int"), F.lit(0))


def parse_timestamp(c, formats=TIMESTAMP_FORMATS) -> Column:
    """Lenient timestamp: first matching layout wins, otherwise NULL."""
    x = strip(c)
    return F.coalesce(*[F.try_to_timestamp(x, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def null_safe_changed(left: str, right: str, attrs) -> Column:
    """True when any attribute differs, NULL-safely (NULL vs value = change)."""
    return reduce(lambda a, b: a | b,
                  [~F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{a}")) for a in attrs])


def canonical_sha256(*cols: str) -> Column:
    """SHA-256 of the canonical JSON of the given columns (keys sorted)."""
    fields = sorted(cols)
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in fields])), 256)


def load_date_rules(text, today, timezone: str = "UTC") -> Column:
    """Name of the first broken load-date rule, or NULL when the date is valid.

    Shape is checked before parsing because Spark's date cast accepts
    ``2026-2-03`` and a leading blank.
    """
    x = _c(text)
    d = F.try_to_date(x, "yyyy-MM-dd")
    return (F.when(x.isNull(), F.lit("null"))
            .when(F.lit(timezone) != F.lit("UTC"), F.lit("timezone"))
            .when(~x.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.lit("format"))
            .when(d.isNull() | (F.date_format(d, "yyyy-MM-dd") != x), F.lit("calendar"))
            .when(d >= F.lit("9999-12-31").cast("date"), F.lit("open_end"))
            .when(d > F.lit(today).cast("date"), F.lit("future")))


def money(c, precision: int = 8, scale: int = 2) -> Column:
    """Decimal text/number -> DECIMAL(precision, scale) with banker's rounding
    (half to even: 10.005 -> 10.00, 10.015 -> 10.02); unparsable or out of
    range -> NULL."""
    x = strip(c) if isinstance(c, str) else c
    wide = x.try_cast(T.DecimalType(38, 10))
    rounded = F.bround(wide, scale)
    limit = F.lit(10 ** (precision - scale)).cast(T.DecimalType(38, 0))
    return F.when(F.abs(rounded) < limit, rounded).cast(T.DecimalType(precision, scale))
