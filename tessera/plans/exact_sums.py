"""Sums of doubles that do not depend on the order of the rows.

A double is an integer multiple of a power of two. One pass finds, per term, the
number of values, the largest and the smallest non-zero magnitude. They give a
ladder of power-of-two grids that covers every bit of every value. A second pass
cuts each value into whole multiples of the grids and adds those up as BIGINT:
integer addition is exact and may be merged in any order, so partial aggregation,
any partitioning and re-run tasks give the same sums. The driver gets one integer
per term and grid, adds them as integers and rounds once, to the nearest double.

The grids leave enough bits free for the number of rows, so no sum can overflow.
Usual data need three or four grids; data over the whole range of doubles about a
hundred.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLITTER = 134217729.0      # 2^27 + 1: halves a 53-bit number into 26-bit parts


def _times_power(c: Column, e: int) -> Column:
    """``c * 2^e`` in steps that are doubles themselves."""
    while e:
        step = max(-1000, min(1000, e))
        c, e = c * F.lit(2.0 ** step), e - step
    return c


def ladder(n: int, high: float, low: float) -> tuple[list[int], int]:
    """Exponents of the grids for ``n`` values of magnitudes in [low, high], and the bits of each."""
    bits = min(50, 62 - max(1, n).bit_length())
    if bits < 1:
        raise ValueError("too many rows for BIGINT sums")
    top = math.frexp(high)[1]
    last = max(math.frexp(low)[1] - 53, -1074)      # every value is a multiple of 2^last
    return [max(top - bits * (k + 1), last) for k in range(max(1, -(-(top - last) // bits)))], bits


def exact_sums(df: DataFrame, terms: dict[str, Column], group_size: int = 60,
               guard: Column | None = None) -> dict[str, tuple[int, Fraction | float]]:
    """``{name: (count, sum)}`` of DOUBLE terms; NULLs are skipped. The sum is a
    ``Fraction`` without any rounding, or NaN / an infinity where the values hold
    one. No values: ``(0, 0)``. Rows where ``guard`` is true raise.

    Two aggregates over ``df``, without a shuffle of rows; terms go in groups of
    about ``group_size`` sums a pass, so a plan stays bounded."""
    names = list(terms)
    src = df.select(*[terms[c].cast("double").alias(f"t{i}") for i, c in enumerate(names)],
                    (F.lit(False) if guard is None else F.coalesce(guard, F.lit(False))).alias("bad"))
    inf = float("inf")
    bounds: dict[int, tuple] = {}
    for i0 in range(0, len(names), group_size):
        idx = range(i0, min(len(names), i0 + group_size))
        aggs = []
        for i in idx:
            x, size = F.col(f"t{i}"), F.abs(F.col(f"t{i}"))
            finite = ~F.isnan(x) & (size < F.lit(inf))
            aggs += [F.count(x), F.max(F.when(finite, size)), F.min(F.when(finite & (size > 0), size)),
                     F.count_if(F.isnan(x)), F.count_if(x == F.lit(inf)), F.count_if(x == F.lit(-inf))]
        r = src.agg(*aggs, F.coalesce(F.max("bad"), F.lit(False))).first()
        if r[-1]:
            raise ValueError("a product leaves the range in which it can be split exactly")
        for k, i in enumerate(idx):
            bounds[i] = tuple(r[6 * k:6 * k + 6])

    out: dict[str, tuple[int, Fraction | float]] = {}
    open_terms = []
    for i, name in enumerate(names):
        n, high, low, nans, ups, downs = bounds[i]
        if nans or (ups and downs):
            out[name] = (n, float("nan"))
        elif ups or downs:
            out[name] = (n, inf if ups else -inf)
        elif low is None:
            out[name] = (n, Fraction(0))
        else:
            open_terms.append((i, name, *ladder(n, high, low)))
    while open_terms:
        group, sums = [], 0
        while open_terms and (not group or sums + len(open_terms[0][2]) <= group_size):
            group.append(open_terms.pop(0))
            sums += len(group[-1][2])
        for (i, name, grids, _), totals in zip(group, _grid_sums(src, group)):
            out[name] = (bounds[i][0], sum((Fraction(s) * Fraction(2) ** e for s, e in zip(totals, grids)), Fraction(0)))
    return {name: out[name] for name in names}


def _grid_sums(src: DataFrame, group: list) -> list[list[int]]:
    """Per term the whole multiples of each of its grids, summed."""
    cur = src.select(*[F.col(f"t{i}").alias(f"r{i}") for i, *_ in group])
    for level in range(max(len(grids) for _, _, grids, _ in group)):
        live = [(i, grids[level]) for i, _, grids, _ in group if level < len(grids)]
        cur = cur.withColumns({f"k{i}_{level}": _times_power(F.col(f"r{i}"), -e).cast("long") for i, e in live})
        cur = cur.withColumns({f"r{i}": F.col(f"r{i}") - _times_power(F.col(f"k{i}_{level}").cast("double"), e)
                               for i, e in live})
    aggs = [F.coalesce(F.sum(f"k{i}_{level}"), F.lit(0)) for i, _, grids, _ in group for level in range(len(grids))]
    got = list(cur.agg(*aggs).first())
    out = []
    for _, _, grids, _ in group:
        out.append([int(v) for v in got[:len(grids)]])
        got = got[len(grids):]
    return out


def product_terms(x: Column, y: Column) -> tuple[Column, Column, Column]:
    """``(p, e, bad)``: the rounded product and its rounding error, so that ``p + e``
    is ``x * y`` exactly; ``bad`` marks rows where this does not hold (magnitudes
    near the ends of the range of doubles)."""
    def halves(v):
        c = v * F.lit(SPLITTER)
        high = c - (c - v)
        return high, v - high

    (xh, xl), (yh, yl), p = halves(x), halves(y), x * y
    e = ((xh * yh - p) + xh * yl + xl * yh) + xl * yl
    bad = ((F.abs(x) > F.lit(2.0 ** 990)) | (F.abs(y) > F.lit(2.0 ** 990)) | (F.abs(p) > F.lit(2.0 ** 1020))
           | F.isnan(p) | ((x != 0) & (y != 0) & (F.abs(p) < F.lit(2.0 ** -960))))
    return p, e, bad


def nearest(total: Fraction | float) -> float:
    """The double nearest to an exact sum (an infinity beyond the range)."""
    if isinstance(total, float):
        return total
    try:
        return total.numerator / total.denominator
    except OverflowError:
        return math.inf if total > 0 else -math.inf
