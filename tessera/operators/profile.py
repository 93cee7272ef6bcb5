"""Column profiles and whole-column aggregates.

Every profile is one aggregate over all requested columns (never a job per
column). Results are long-form DataFrames with one row per column, so they are
bounded by the number of columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.missing import number
from tessera.plans.quantile import column_stats, exact_medians


def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """count (neither NULL nor NaN), mean, sample std (n-1), true min and max per column.

    One ``agg`` (partial + final hash aggregate); the single result row is
    unpivoted with ``stack`` semantics.
    """
    aggs = []
    for i, c in enumerate(cols):
        x = number(c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").cast("long").alias("count"),
                     F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
                     F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
            for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _string_long(df: DataFrame, cols: list[str]) -> DataFrame:
    items = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
             for c in cols]
    return (df.select(F.explode(F.array(*items)).alias("r")).select("r.*")
            .where(F.col("value").isNotNull()))


def value_counts_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, n) for every non-NULL value of every column.

    ``groupBy(column, value)`` with map-side combine: a value that holds a
    third of all rows is pre-counted in every map task, so the shuffle carries
    one row per (task, distinct value).
    """
    return _string_long(df, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n) of one column, NULLs excluded."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


def describe_string(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, unique, top, freq per string column.

    ``top`` is the most frequent value, ties broken by the smallest string.
    Two aggregates: value counts, then per column ``min_by`` over
    ``(-n, value)`` which keeps O(1) state per column and task (Spark's
    ``mode`` would hold every distinct value of a column in one buffer).
    """
    vc = value_counts_long(df, cols)
    return (vc.groupBy("column")
            .agg(F.sum("n").cast("long").alias("count"),
                 F.count(F.lit(1)).cast("long").alias("unique"),
                 F.min_by("value", F.struct((-F.col("n")).alias("k"), F.col("value").alias("v"))).alias("top"),
                 F.max("n").cast("long").alias("freq")))


def modes(df: DataFrame, cols: list[str]) -> dict[str, str | None]:
    """Most frequent non-NULL value of each column (smallest on ties)."""
    got = {r["column"]: r["top"] for r in describe_string(df, cols).collect()}
    return {c: got.get(c) for c in cols}


def mean_median(df: DataFrame, cols: list[str], approx: bool = False,
                accuracy: int = 10_000) -> DataFrame:
    """(column, mean, median) with an exact median that never gathers a
    column into one task (see ``plans.quantile``). ``approx=True`` uses one
    ``percentile_approx`` aggregate instead (rank error <= n / accuracy)."""
    spark = df.sparkSession
    if approx:
        aggs = []
        for i, c in enumerate(cols):
            x = number(c)
            aggs += [F.avg(x).alias(f"m{i}"), F.percentile_approx(x, 0.5, accuracy).alias(f"q{i}")]
        wide = df.agg(*aggs)
        rows = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("mean"),
                         F.col(f"q{i}").cast("double").alias("median")) for i, c in enumerate(cols)]
        return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    stats = column_stats(df, cols)
    med = exact_medians(df, cols, stats)
    rows = [(c, stats[c].mean, med[c]) for c in cols]
    return spark.createDataFrame(rows, "column string, mean double, median double")


def medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    return exact_medians(df, cols, column_stats(df, cols))


def squared_error(df: DataFrame, pred: str, true: str) -> DataFrame:
    """sum and mean of (pred - true)^2 over rows with both values."""
    d = number(pred) - number(true)
    return df.agg(F.sum(d * d).alias("sse"), F.avg(d * d).alias("mse"))


def row_count(df: DataFrame) -> DataFrame:
    """Number of samples as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("n"))
