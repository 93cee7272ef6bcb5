"""Means, squared errors and AᵀB whose bits do not depend on row order, partitions
or re-run tasks (A4, A6, M7; see ``plans.exact_sums``).

The plain forms in ``operators.profile`` and ``operators.linalg`` add doubles in
the order in which tasks end. These add integers and round once, for a second pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.missing import number
from tessera.plans.exact_sums import exact_sums, nearest, product_terms


def _mean(n: int, total: float) -> float | None:
    return total / n if n else None


def exact_means(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, count, sum, mean) of numeric columns; NULL and NaN are missing. The
    sum is the exact one rounded to the nearest double (NULL without values), the
    mean that double divided by the count."""
    got = exact_sums(df, {c: number(c) for c in cols})
    rows = []
    for c in cols:
        n, total = got[c]
        s = nearest(total)
        rows.append((c, n, s if n else None, _mean(n, s)))
    return df.sparkSession.createDataFrame(rows, "column string, count long, sum double, mean double")


def exact_squared_error(df: DataFrame, pred: str, true: str) -> DataFrame:
    """(sse, mse) of the differences ``pred - true`` (each a double) over rows with
    both values: the squares are not rounded, their sum is, once."""
    d = number(pred) - number(true)
    p, e, bad = product_terms(F.col("d"), F.col("d"))
    got = exact_sums(df.select(d.alias("d")), {"p": p, "e": e}, guard=bad)
    n = got["p"][0]
    sse = nearest(got["p"][1] + got["e"][1])
    row = (sse if n else None, _mean(n, sse))
    return df.sparkSession.createDataFrame([row], "sse double, mse double")


def exact_gram(df: DataFrame, left: list[str], right: list[str]) -> DataFrame:
    """AᵀB of numeric columns as cells ``(i, j, v)``: sums of unrounded products over
    rows with both values, rounded once. For model-sized widths: one cell a pair."""
    src = df.select(*[number(c).alias(f"a{i}") for i, c in enumerate(left)],
                    *[number(c).alias(f"b{j}") for j, c in enumerate(right)])
    terms, guard = {}, F.lit(False)
    for i in range(len(left)):
        for j in range(len(right)):
            p, e, bad = product_terms(F.col(f"a{i}"), F.col(f"b{j}"))
            terms[f"p{i},{j}"], terms[f"e{i},{j}"] = p, e
            guard = guard | F.coalesce(bad, F.lit(False))
    got = exact_sums(src, terms, guard=guard)
    rows = [(i, j, nearest(got[f"p{i},{j}"][1] + got[f"e{i},{j}"][1])) for i in range(len(left)) for j in range(len(right))]
    return df.sparkSession.createDataFrame(rows, "i long, j long, v double")
