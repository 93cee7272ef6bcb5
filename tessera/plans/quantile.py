"""Exact order statistics without gathering a column into one task.

Spark's exact ``median``/``percentile`` keep a value->count map per group and
merge it in a single task; for a whole-column median of a continuous column
that map is as large as the data. Here the k-th smallest value is bracketed by
rank:

* a quantile sketch (one aggregate, bounded state) gives two values around the
  wanted rank; the first one comes with the count/min/max aggregate;
* one grouped count tells how many values lie below and inside the bracket;
* brackets narrow by rank, whatever the spread of the values, until at most
  ``FINAL_ROWS`` rows are inside; these are counted by value (a bounded set).

A bracket that does not shrink is heavy at its ends: they are tested and cut
off, so every round makes progress and no limit on rounds is needed. Infinite
values are compared like any other; NaN is missing. All columns (and both middle
ranks of an even count) advance in the same job.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.missing import number

FINAL_ROWS = 50_000
ACCURACY = 20_000       # of the sketch: rank error at most rows / ACCURACY
MARGIN = 2.0 / ACCURACY


class Stats(NamedTuple):
    """count, min, max, mean of the present values; ``around``: sketched values
    that bracket the median."""
    n: int
    lo: float | None
    hi: float | None
    mean: float | None = None
    around: tuple[float, float] | None = None


@dataclass
class _State:
    col: str
    k: int          # wanted rank, 0-based, among all present values of col
    lo: float
    hi: float
    below: int      # number of values < lo
    n_in: int       # number of values in [lo, hi]
    guess: tuple[float, float] | None = None
    value: float | None = None


def kth_values(df: DataFrame, wanted: list[tuple[str, int]], stats: dict[str, Stats]) -> list[float | None]:
    """Exact k-th smallest present value for each ``(column, k)``."""
    states: list[_State] = []
    for c, k in wanted:
        st = Stats(*stats[c])
        if not st.n or k < 0 or k >= st.n:
            states.append(_State(c, k, 0.0, 0.0, 0, -1))
            continue
        middle = k in ((st.n - 1) // 2, st.n // 2)
        s = _State(c, k, float(st.lo), float(st.hi), 0, int(st.n), st.around if middle else None)
        if s.lo == s.hi:
            s.value = s.lo
        states.append(s)
    while open_ := [s for s in states if s.value is None and s.n_in > 0]:
        large = [s for s in open_ if s.n_in > FINAL_ROWS]
        sketch = [s for s in large if s.guess is None]
        if sketch:
            _sketch(df, sketch)
        if large:
            _narrow(df, large)
        small = [s for s in open_ if s.value is None and s.n_in <= FINAL_ROWS]
        if small:
            _finish(df, small)
    return [s.value for s in states]


def _inside(s: _State):
    c = number(s.col)
    return F.when(c.between(F.lit(s.lo), F.lit(s.hi)), c)


def _sketch(df: DataFrame, states: list[_State]) -> None:
    aggs = []
    for i, s in enumerate(states):
        p = (s.k - s.below) / s.n_in
        qs = [max(0.0, p - MARGIN), min(1.0, p + MARGIN)]
        aggs.append(F.percentile_approx(_inside(s), qs, ACCURACY).alias(f"q{i}"))
    r = df.agg(*aggs).first()
    for i, s in enumerate(states):
        s.guess = (float(r[f"q{i}"][0]), float(r[f"q{i}"][1]))


def _narrow(df: DataFrame, states: list[_State]) -> None:
    aggs = []
    for i, s in enumerate(states):
        c = _inside(s)
        a, b = (F.lit(x) for x in s.guess)
        aggs += [F.count_if(c < a).alias(f"u{i}"), F.count_if((c >= a) & (c <= b)).alias(f"m{i}"),
                 F.max(F.when(c < a, c)).alias(f"ua{i}"), F.min(F.when(c > b, c)).alias(f"ob{i}"),
                 F.count_if(c == s.lo).alias(f"l{i}"), F.count_if(c == s.hi).alias(f"h{i}"),
                 F.min(F.when(c > s.lo, c)).alias(f"nl{i}"), F.max(F.when(c < s.hi, c)).alias(f"nh{i}")]
    r = df.agg(*aggs).first()
    for i, s in enumerate(states):
        under, mid, before = r[f"u{i}"], r[f"m{i}"], s.n_in
        rank = s.k - s.below
        if rank < r[f"l{i}"]:
            s.value = s.lo
        elif rank >= before - r[f"h{i}"]:
            s.value = s.hi
        elif rank < under:
            s.hi, s.n_in = float(r[f"ua{i}"]), under
        elif rank < under + mid:
            s.lo, s.hi = s.guess
            s.below, s.n_in = s.below + under, mid
        else:
            s.lo, s.below, s.n_in = float(r[f"ob{i}"]), s.below + under + mid, before - under - mid
        if s.value is None and s.n_in == before:
            # nothing left out: drop the two end values, of which neither is wanted
            s.lo, s.hi = float(r[f"nl{i}"]), float(r[f"nh{i}"])
            s.below += r[f"l{i}"]
            s.n_in = before - r[f"l{i}"] - r[f"h{i}"]
        s.guess = None
        if s.value is None and s.lo == s.hi:
            s.value = s.lo


def _finish(df: DataFrame, states: list[_State]) -> None:
    probes: dict[tuple, list[_State]] = {}
    for s in states:
        probes.setdefault((s.col, s.lo, s.hi), []).append(s)
    items = []
    for pid, group in enumerate(probes.values()):
        c = _inside(group[0])
        items.append(F.when(c.isNotNull(), F.struct(F.lit(pid).alias("pid"), c.alias("v"))))
    rows = (df.select(F.inline(F.array(*items))).where(F.col("pid").isNotNull())
            .groupBy("pid", "v").agg(F.count(F.lit(1)).alias("n")).collect())     # at most FINAL_ROWS each
    by_pid: dict[int, list] = {}
    for r in rows:
        by_pid.setdefault(r["pid"], []).append((r["v"], r["n"]))
    for pid, group in enumerate(probes.values()):
        for s in group:
            cum = s.below
            for v, n in sorted(by_pid.get(pid, [])):
                if cum + n > s.k:
                    s.value = float(v)
                    break
                cum += n


def exact_medians(df: DataFrame, cols: list[str],
                  stats: dict[str, Stats] | None = None) -> dict[str, float | None]:
    """Interpolated median (mean of the two middle values for an even count)
    of the present values of every column; NULL for an empty column."""
    if stats is None:
        stats = column_stats(df, cols)
    wanted = []
    for c in cols:
        n = Stats(*stats[c]).n or 0
        wanted += [(c, (n - 1) // 2), (c, n // 2)]
    vals = kth_values(df, wanted, stats)
    out = {}
    for i, c in enumerate(cols):
        a, b = vals[2 * i], vals[2 * i + 1]
        out[c] = a if a is None or a == b else a + (b - a) * 0.5
    return out


def column_stats(df: DataFrame, cols: list[str]) -> dict[str, Stats]:
    """Count, min, max, mean and a bracket of the median of every column in one
    aggregate."""
    aggs = []
    for i, c in enumerate(cols):
        x = number(c)
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 F.avg(x).alias(f"m{i}"),
                 F.percentile_approx(x, [0.5 - MARGIN, 0.5 + MARGIN], ACCURACY).alias(f"q{i}")]
    r = df.agg(*aggs).first()
    return {c: Stats(r[f"n{i}"], r[f"lo{i}"], r[f"hi{i}"], r[f"m{i}"], tuple(r[f"q{i}"]) if r[f"q{i}"] else None)
            for i, c in enumerate(cols)}
