"""Sums that do not depend on row order, whole previews, footers."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators.exact import exact_gram, exact_means, exact_squared_error
from tessera.plans.exact_sums import exact_sums, ladder, nearest
from tessera.sources.footers import footer_profile
from tessera.sources.preview import preview


def table(spark, cols, parts):
    names = [f"c{i}" for i in range(len(cols))]
    return spark.createDataFrame(list(zip(*cols)), ", ".join(f"{n} double" for n in names)).repartition(parts), names


def test_sums_are_exact_over_the_whole_range_of_doubles(spark):
    rnd = random.Random(5)
    columns = [
        [1e308, 1.0, -1e308, 5e-324, -1.0, 2.0 ** -1060, 3.0],
        [0.1] * 7,
        [0.0, -0.0, None, None, 0.0, None, 0.0],
        [5e-324, 5e-324, -5e-324, 1.5e-320, 0.0, None, 2e-310],
        [2.0 ** 60, 1.0, -(2.0 ** 60), 2.0 ** -40, 1e16, -1e16, 0.5],
        [rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-30, 30) for _ in range(7)],
        [1.7e308, 1.7e308, 1.7e308, 0.0, 0.0, 0.0, 0.0],
    ]
    df, names = table(spark, columns, 3)
    got = exact_sums(df, {n: F.col(n) for n in names})
    for n, values in zip(names, columns):
        held = [v for v in values if v is not None]
        assert got[n] == (len(held), sum((Fraction(v) for v in held), Fraction(0))), n
    assert nearest(got["c0"][1]) == 3.0 and nearest(got["c6"][1]) == math.inf


def test_bits_do_not_depend_on_partitions(spark):
    rnd = random.Random(9)
    x = [rnd.gauss(0, 1) * 10.0 ** rnd.randint(-8, 8) for _ in range(3000)]
    y = [v * rnd.uniform(0.5, 1.5) if i % 50 else float("nan") for i, v in enumerate(x)]
    want = None
    for parts in (1, 3, 11):
        df, _ = table(spark, [x, y], parts)
        got = (exact_means(df, ["c0", "c1"]).collect(), exact_squared_error(df, "c0", "c1").collect(),
               exact_gram(df, ["c0", "c1"], ["c0", "c1"]).collect())
        want = want or got
        assert got == want
    both = [(a, b) for a, b in zip(x, y) if b == b]
    means, (error,), cells = want
    assert means[0]["sum"] == math.fsum(x) and means[1]["sum"] == math.fsum(b for _, b in both)
    assert means[0]["mean"] == math.fsum(x) / 3000 and means[1]["count"] == len(both)
    sse = sum(Fraction(a - b) ** 2 for a, b in both)
    assert error.sse == float(sse) and error.mse == float(sse) / len(both)
    assert {(r.i, r.j): r.v for r in cells}[(0, 1)] == float(sum(Fraction(a) * Fraction(b) for a, b in both))


def test_missing_infinite_and_empty_columns(spark):
    df, _ = table(spark, [[math.inf, 1.0], [math.inf, -math.inf], [None, float("nan")]], 2)
    rows = {r["column"]: r for r in exact_means(df, ["c0", "c1", "c2"]).collect()}
    assert rows["c0"]["sum"] == math.inf and math.isnan(rows["c1"]["mean"])
    assert tuple(rows["c2"])[1:] == (0, None, None)
    assert tuple(exact_means(df.limit(0), ["c0"]).first()) == ("c0", 0, None, None)
    assert tuple(exact_squared_error(df.limit(0), "c0", "c1").first()) == (None, None)
    tiny, _ = table(spark, [[1e-200, 1.0], [1e-200, 1.0]], 1)
    with pytest.raises(ValueError):
        exact_gram(tiny, ["c0"], ["c1"])


def test_grids_leave_room_for_the_rows():
    for n in (1, 1000, 10 ** 12):
        grids, bits = ladder(n, 1e300, 1e-300)
        assert n * 2 ** bits < 2 ** 63 and grids == sorted(grids, reverse=True)
        assert all(a - b <= bits for a, b in zip(grids, grids[1:])) and math.frexp(1e300)[1] - grids[0] <= bits


def test_previews_of_either_end_and_of_all_rows(spark):
    df = spark.createDataFrame([(i, float(i), "s") for i in range(500)], "row_id long, v double, s string").repartition(7)
    last = [tuple(r) for r in preview(df, 3, end="last").orderBy("row_no").collect()]
    assert last == [(i, f"{i}.00", "s", i + 1) for i in (497, 498, 499)]
    plan = preview(df, 3, end="last")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert [(r.row_id, r.row_no) for r in preview(df, -1).orderBy("row_no").collect()] == [(i, i + 1) for i in range(500)]
    assert preview(df, 0, end="last").count() == 0 and preview(df.limit(0), 3, end="last").count() == 0
    assert preview(df, 900, end="last").count() == 500
    with pytest.raises(ValueError):
        preview(df, 3, end="middle")


def test_footers_answer_counts_and_bounds(spark, tmp_path):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    path = str(tmp_path / "t")
    (spark.range(10_000).selectExpr("CAST(id AS INT) AS k", "IF(id % 3 = 0, NULL, id - 5000) AS v",
                                    "date_add(DATE '2020-01-01', CAST(id % 400 AS INT)) AS d", "CAST(id AS DOUBLE) AS x")
     .repartition(5).write.parquet(path))
    got = footer_profile(spark, path, ["k", "v", "d"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)" in plan and "MIN(k)" in plan and "MAX(v)" in plan
    want = spark.read.parquet(path).selectExpr("count(*)", *[f"{f}({c})" for c in "kvd" for f in ("count", "min", "max")])
    assert tuple(got.first()) == tuple(want.first())
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    with pytest.raises(ValueError):
        footer_profile(spark, path, ["x"])
    spark.range(0).write.parquet(str(tmp_path / "e"))
    assert tuple(footer_profile(spark, str(tmp_path / "e"), ["id"]).first()) == (0, 0, None, None)


def test_footers_of_a_shared_table(spark):
    n = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    assert footer_profile(spark, f"{SF_SMALL}/orders.parquet", ["o_orderkey"]).first().n == n
