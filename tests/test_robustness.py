"""Behaviour that must not depend on sizes, split layouts or file counts."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import encode, linalg as la
from tessera.operators.impute import fit_imputer
from tessera.operators.profile import describe_numeric, mean_median
from tessera.plans import quantile as q
from tessera.sources.csv import make_csv, read_csv


def test_csv_keeps_all_rows_when_split_layout_changes(spark, tmp_path):
    n = 20_000
    folder = str(tmp_path / "t")
    spark.range(n).selectExpr("id", "concat('v', id) AS s").coalesce(1).write.csv(folder)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
        t = read_csv(spark, folder, names=["k", "s"])
        spark.conf.set("spark.sql.files.maxPartitionBytes", "70000")
        r = t.df.agg(F.count("*"), F.countDistinct("row_id"), F.min("row_id"), F.max("row_id"),
                     F.count_if(F.col("row_id") == F.col("k"))).first()
        assert tuple(r) == (n, n, 0, n - 1, n)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_headerless_files_lose_no_row(spark, tmp_path):
    for k in (2, 10, 100):
        (tmp_path / f"part-{k}.csv").write_text("".join(f"a{k}_{i},b\n" for i in range(4)) + "\n")
    t = read_csv(spark, str(tmp_path))
    rows = t.df.orderBy("row_id").collect()
    assert not t.header and t.df.columns == ["row_id", "c0", "c1"]
    assert [r.c0 for r in rows] == [f"a{k}_{i}" for k in (2, 10, 100) for i in range(4)]
    assert [r.row_id for r in rows] == list(range(12))


def test_csv_same_header_in_every_file(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"f{k}.csv").write_text("name,x\n" + f"r{k},{k}\nNA,\n")
    t = read_csv(spark, str(tmp_path))
    assert t.header and t.numeric == ["x"] and t.strings == ["name"]
    assert [(r.row_id, r.name, r.x) for r in t.df.orderBy("row_id").collect()] == [
        (0, "r0", 0.0), (1, None, None), (2, "r1", 1.0), (3, None, None), (4, "r2", 2.0), (5, None, None)]


def test_csv_strings_keep_blanks_and_refuse_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(0, " a "), (1, "b")], "row_id long, s string")
    make_csv(df, str(tmp_path / "x"), [], ["s"])
    assert [r.s for r in read_csv(spark, str(tmp_path / "x")).df.orderBy("row_id").collect()] == [" a ", "b"]
    with pytest.raises(Exception, match="line break"):
        make_csv(spark.createDataFrame([(0, "a\nb")], "row_id long, s string"), str(tmp_path / "y"), [], ["s"])


@pytest.mark.parametrize("cells", [0, 10_000])
def test_products_follow_one_null_rule(spark, monkeypatch, cells):
    monkeypatch.setattr(la, "EXPR_CELLS", cells)
    a = spark.createDataFrame([(0, [1.0, 2.0]), (1, [None, 3.0]), (2, None)], "i int, x array<double>")
    out = {r.i: r.x for r in la.rows_matmul_small(a, np.array([[1.0, 0.0], [1.0, 2.0]]), 2).collect()}
    assert out == {0: [3.0, 4.0], 1: [None, None], 2: [None, None]}
    g = spark.createDataFrame([([1.0, None], [2.0]), ([3.0, None], [4.0])], "x array<double>, y array<double>")
    assert {(r.i, r.j): r.v for r in la.gram_cells(g, 2, 1).collect()} == {(0, 0): 14.0, (1, 0): None}
    with pytest.raises(Exception, match="width"):
        la.rows_matmul_small(spark.createDataFrame([(0, [1.0])], "i int, x array<double>"), np.eye(2), 2).collect()
    with pytest.raises(Exception, match="width"):
        la.gram_cells(spark.createDataFrame([([1.0], [1.0])], "x array<double>, y array<double>"), 2, 1).collect()


def test_wide_right_side_goes_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(la, "EXPR_CELLS", 0)
    monkeypatch.setattr(la, "SMALL_CELLS", 4)
    w = np.arange(10.0).reshape(2, 5)
    a = spark.createDataFrame([(0, [1.0, 2.0])], "i int, x array<double>")
    assert la.rows_matmul_small(a, w, 2).first().x == list(np.array([1.0, 2.0]) @ w)


def test_elementwise_refuses_unmatched_rows(spark):
    a = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "i int, x array<double>")
    b = spark.createDataFrame([(0, [5.0])], "i int, x array<double>")
    with pytest.raises(Exception, match="shape mismatch"):
        la.rows_elementwise(a, b, ["i"], "add", 1, 1).collect()
    ca, cb = (la.rows_to_cells(t, "i") for t in (a, b))
    with pytest.raises(Exception, match="shape mismatch"):
        la.cells_elementwise(ca, cb, "mul").collect()
    assert la.rows_elementwise(b, b, ["i"], "sub", 1, 1).first().x == [0.0]


def test_median_of_any_spread(spark, monkeypatch):
    monkeypatch.setattr(q, "FINAL_ROWS", 50)
    monkeypatch.setattr(q, "MARGIN", 0.01)
    rng = np.random.default_rng(1)
    v = 10.0 ** rng.uniform(-300, 300, 20_000)
    v[:3] = np.inf
    v[3:9_000] = 7.0                                    # heavy ties
    df = spark.createDataFrame([(float(x),) for x in v] + [(float("nan"),), (None,)], "x double")
    assert q.exact_medians(df, ["x"])["x"] == np.median(v)
    st = q.column_stats(df, ["x"])
    ks = [0, 1, 5_000, 12_000, len(v) - 3, len(v) - 1]
    assert q.kth_values(df, [("x", k) for k in ks], st) == list(np.sort(v)[ks])
    assert q.exact_medians(df.where("x = 'Infinity'"), ["x"])["x"] == np.inf


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    r = describe_numeric(df, ["x"]).first()
    assert (r["count"], r["mean"], r["min"], r["max"]) == (2, 2.0, 1.0, 3.0)
    assert tuple(mean_median(df, ["x"]).first())[1:] == (2.0, 2.0)
    for strategy in ("mean", "median"):
        out = fit_imputer(df, ["x"], strategy).transform(df)
        assert sorted(x.x for x in out.collect()) == [1.0, 2.0, 2.0, 3.0]


def test_numeric_classes_are_exact(spark):
    big = 9007199254740992
    df = spark.createDataFrame([(0, big), (1, big + 1)], "row_id long, y long")
    assert encode.fit_dictionary(df, encode.numeric_key(F.col("y"), "bigint")).size == 2
    df = spark.createDataFrame([(0, 0.0), (1, -0.0), (2, float("nan")), (3, None)], "row_id long, y double")
    assert encode.fit_dictionary(df, encode.numeric_key(F.col("y"))).size == 2


def test_package_is_shipped(spark):
    from tessera.session import ship_package
    ship_package(spark)
    assert any("tessera_package.zip" in os.path.basename(f) for f in spark.sparkContext.listFiles)
