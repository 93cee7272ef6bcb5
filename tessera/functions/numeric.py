"""Small numeric column helpers shared by operators and oracle queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(c: Column | str, digits: int) -> Column:
    """``round(x * 10^d) / 10^d`` with ties away from zero, in double
    arithmetic (codegen'd; no per-value BigDecimal). -0.0 becomes 0.0; values
    too large to carry a fraction, NaN and NULL are returned unchanged."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    scale = float(10 ** digits)
    v = x * F.lit(scale)
    fl = F.floor(v).cast("double")
    tie = (v - fl) == F.lit(0.5)
    r = F.when(tie, F.when(v >= 0, fl + F.lit(1.0)).otherwise(fl)).otherwise(F.rint(v)) / F.lit(scale)
    r = F.when(F.abs(v) < F.lit(4.5e15), r).otherwise(x)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)


def r4(c: Column | str) -> Column:
    """Round half away from zero to 4 decimals as DOUBLE (result comparison)."""
    return round_half_away(c, 4)


def safe_div(a: Column, b: Column) -> Column:
    """a / b, NULL when b is 0 or NULL (ANSI mode would raise)."""
    return F.try_divide(a, b)


def dbl(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double")


def double_array(c: Column | str) -> Column:
    """ARRAY<FLOAT> (or any numeric array) -> ARRAY<DOUBLE> before arithmetic."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("array<double>")


def double_array_lit(values) -> Column:
    """ARRAY<DOUBLE> literal built from one SQL expression (one call to the
    JVM instead of one per element)."""
    vals = [float(v) for v in values]
    if not vals:
        return F.array().cast("array<double>")
    if not all(v == v and abs(v) != float("inf") for v in vals):
        return F.array(*[F.lit(v) for v in vals])
    return F.expr("array(" + ", ".join(f"{v!r}D" for v in vals) + ")")
