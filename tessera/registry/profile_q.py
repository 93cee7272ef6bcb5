"""Profiles and whole-column aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.numeric import r4
from tessera.operators import exact, profile
from tessera.registry.base import R, query, tbl
from tessera.sources.footers import footer_profile

LINE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union_sql(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


DESCRIBE_NUMERIC_SQL = _union_sql([
    f"SELECT '{c}' AS feature, count({c}) AS count, {R(f'avg({c})')} AS mean, "
    f"{R(f'stddev_samp({c})')} AS std, {R(f'min({c})')} AS min, {R(f'max({c})')} AS max FROM lineitem"
    for c in LINE_NUM])


@query("describe_numeric", DESCRIBE_NUMERIC_SQL)
def q_describe_numeric(spark, sf):
    d = profile.describe_numeric(tbl(spark, sf, "lineitem", LINE_NUM), LINE_NUM)
    return d.select(F.col("column").alias("feature"), "count", r4("mean").alias("mean"),
                    r4("std").alias("std"), r4("min").alias("min"), r4("max").alias("max"))


ORDER_STR = ["o_orderstatus", "o_orderpriority"]
DESCRIBE_STRING_SQL = f"""
WITH long AS ({_union_sql([f"SELECT '{c}' AS feature, {c} AS value FROM orders" for c in ORDER_STR])}),
vc AS (SELECT feature, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY feature, value),
ranked AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value ASC) AS rk FROM vc)
SELECT feature, CAST(sum(n) AS BIGINT) AS count, CAST(count(*) AS BIGINT) AS n_unique,
       max(CASE WHEN rk = 1 THEN value END) AS top, CAST(max(n) AS BIGINT) AS freq
FROM ranked GROUP BY feature
"""


@query("describe_string", DESCRIBE_STRING_SQL)
def q_describe_string(spark, sf):
    d = profile.describe_string(tbl(spark, sf, "orders", ORDER_STR), ORDER_STR)
    return d.select(F.col("column").alias("feature"), "count", F.col("unique").alias("n_unique"),
                    "top", "freq")


@query("value_counts", """
SELECT o_orderpriority AS value, count(*) AS n FROM orders
WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority
""")
def q_value_counts(spark, sf):
    return profile.value_counts(tbl(spark, sf, "orders", ["o_orderpriority"]), "o_orderpriority")


MM_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("mean_median", _union_sql([
    f"SELECT '{c}' AS feature, {R(f'avg({c})')} AS mean, {R(f'median({c})')} AS median FROM lineitem"
    for c in MM_COLS]))
def q_mean_median(spark, sf):
    d = profile.mean_median(tbl(spark, sf, "lineitem", MM_COLS), MM_COLS)
    return d.select(F.col("column").alias("feature"), r4("mean").alias("mean"), r4("median").alias("median"))


@query("squared_error", f"""
SELECT {R('sum((l_discount - l_tax) * (l_discount - l_tax))')} AS sse,
       {R('avg((l_discount - l_tax) * (l_discount - l_tax))')} AS mse
FROM lineitem
""")
def q_squared_error(spark, sf):
    d = profile.squared_error(tbl(spark, sf, "lineitem", ["l_discount", "l_tax"]), "l_discount", "l_tax")
    return d.select(r4("sse").alias("sse"), r4("mse").alias("mse"))


@query("dataset_count", "SELECT CAST(count(*) AS BIGINT) AS n FROM orders")
def q_dataset_count(spark, sf):
    return profile.row_count(tbl(spark, sf, "orders", ["o_orderkey"]))


# Every value of these columns is a multiple of 2^-60, so the oracle can add whole numbers.
def _exact_sum_sql(expr: str, scale: int) -> str:
    """The exact sum of doubles (multiples of 2^-scale), rounded once, by its decimal digits."""
    return (f"CAST(CAST(sum(CAST({expr} * {float(2 ** scale)!r} AS HUGEINT)) AS VARCHAR) AS DOUBLE) / {float(2 ** scale)!r}")


@query("mean_exact", _union_sql([
    f"SELECT feature, n, total, total / n AS mean FROM (SELECT '{c}' AS feature, count({c}) AS n, "
    f"{_exact_sum_sql(c, 60)} AS total FROM lineitem)" for c in LINE_NUM]))
def q_mean_exact(spark, sf):
    """Sums and means to the last bit, without rounding in the query."""
    d = exact.exact_means(tbl(spark, sf, "lineitem", LINE_NUM), LINE_NUM)
    return d.select(F.col("column").alias("feature"), F.col("count").alias("n"), F.col("sum").alias("total"), "mean")


def _exact_product_sql(x: str, y: str, sx: int, sy: int) -> str:
    """The exact sum of products of doubles that are multiples of 2^-sx and 2^-sy."""
    whole = f"sum(CAST({x} * {float(2 ** sx)!r} AS HUGEINT) * CAST({y} * {float(2 ** sy)!r} AS HUGEINT))"
    return f"CAST(CAST({whole} AS VARCHAR) AS DOUBLE) / {float(2 ** (sx + sy))!r}"


@query("squared_error_exact", f"""
SELECT sse, sse / n AS mse FROM (
  SELECT {_exact_product_sql("(l_discount - l_tax)", "(l_discount - l_tax)", 59, 59)} AS sse,
         count(l_discount - l_tax) AS n FROM lineitem)
""")
def q_squared_error_exact(spark, sf):
    return exact.exact_squared_error(tbl(spark, sf, "lineitem", ["l_discount", "l_tax"]), "l_discount", "l_tax")


_GRAM_LEFT, _GRAM_RIGHT = [("l_quantity", 0), ("l_discount", 59)], [("l_tax", 59), ("l_quantity", 0)]


@query("gram_exact", _union_sql([
    f"SELECT {i}::BIGINT AS i, {j}::BIGINT AS j, {_exact_product_sql(a, b, sa, sb)} AS v FROM lineitem"
    for i, (a, sa) in enumerate(_GRAM_LEFT) for j, (b, sb) in enumerate(_GRAM_RIGHT)]))
def q_gram_exact(spark, sf):
    left, right = [c for c, _ in _GRAM_LEFT], [c for c, _ in _GRAM_RIGHT]
    return exact.exact_gram(tbl(spark, sf, "lineitem", sorted({*left, *right})), left, right)


@query("footer_profile", """
SELECT count(*) AS n, count(o_orderkey) AS o_orderkey_count, min(o_orderkey) AS o_orderkey_min,
       max(o_orderkey) AS o_orderkey_max, count(o_custkey) AS o_custkey_count, min(o_custkey) AS o_custkey_min,
       max(o_custkey) AS o_custkey_max
FROM orders
""")
def q_footer_profile(spark, sf):
    return footer_profile(spark, f"{sf.rstrip('/')}/orders.parquet", ["o_orderkey", "o_custkey"])
