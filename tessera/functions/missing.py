"""Missing-value normalisation (column expressions, JVM-side).

Missing values become SQL NULL in every column: string tokens below, the empty
string, and floating NaN. NaN must never reach an aggregate (Spark sorts NaN
above every number and ``avg`` would return NaN).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens read as "missing" (exact, case-sensitive match).
MISSING_TOKENS = ("NA", "NAN", "NaN", "N/A", "nan", "null", "NULL", "None",
                  "missing", "?", "--", "-")


def is_missing_token(c: Column) -> Column:
    """True when a string value is one of the missing tokens or empty."""
    return c.isin(*MISSING_TOKENS) | (c == F.lit(""))


def normalise_string(c: Column) -> Column:
    """Token or empty string -> NULL, other strings unchanged."""
    return F.when(is_missing_token(c), F.lit(None).cast("string")).otherwise(c)


def parse_double(c: Column) -> Column:
    """String -> DOUBLE with missing tokens as NULL and unparsable text as NULL
    (``12abc`` is not 12)."""
    return (F.when(is_missing_token(c), F.lit(None).cast("double"))
            .otherwise(_nan_to_null(c.try_cast("double"))))


def _nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def nan_to_null(c: Column) -> Column:
    """DOUBLE NaN -> NULL."""
    return _nan_to_null(c)


def number(c: Column | str) -> Column:
    """A numeric column as DOUBLE with NaN as missing (NULL)."""
    return _nan_to_null((F.col(c) if isinstance(c, str) else c).cast("double"))
