"""The code paths taken only at scale, forced with small thresholds: they must
give the same results as the small-data paths."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import tessera.operators.encode as enc
import tessera.operators.linalg as la
import tessera.operators.score as sc
import tessera.plans.joins as joins
import tessera.plans.positions as pos
from tessera.operators.model import Dense, Sequential

from conftest import SF_SMALL


def _codes(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_orderpriority", "o_custkey")
    key = enc.category_key(F.col("o_custkey"))
    d = enc.fit_dictionary(o, key, "o_orderkey")
    out = enc.label_encode(o, key, d).select("o_orderkey", "code")
    return {r[0]: r[1] for r in out.collect()}, {r["value"]: r["code"] for r in d.df.collect()}


def test_large_dictionary_and_salted_lookup(spark, monkeypatch):
    small_rows, small_dict = _codes(spark)
    monkeypatch.setattr(enc, "DICT_WINDOW_MAX", 5)        # rank by bucket offsets
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 3)    # salted shuffle join
    big_rows, big_dict = _codes(spark)
    assert big_dict == small_dict and big_rows == small_rows
    assert sorted(small_dict.values()) == list(range(len(small_dict)))


def test_salted_join_with_hot_key(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    big = spark.range(3000).select(F.col("id").alias("row_id"),
                                   F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                   .otherwise((F.col("id") % 50).cast("string")).alias("k"))
    small = spark.createDataFrame([("hot", 1)] + [(str(i), i + 10) for i in range(50)], "k string, code int")
    out = joins.lookup_join(big, small, ["k"], 51)
    assert out.count() == 3000
    only_keys = joins.lookup_join(big.select("k"), small, ["k"], 51)
    assert only_keys.where("k = 'hot'").count() == 1000
    assert out.where("k = 'hot'").agg(F.min("code"), F.max("code")).collect()[0][:] == (1, 1)


def test_positions_by_key_contiguous(spark):
    df = spark.range(0, 5000, 7).withColumnRenamed("id", "k").repartition(4)
    got = sorted((r["k"], r["pos"]) for r in pos.positions_by_key(df, "k").collect())
    assert [p for _, p in got] == list(range(len(got)))


def test_shuffled_matrix_product(spark, monkeypatch):
    monkeypatch.setattr(la, "SMALL_CELLS", 1)
    rng = np.random.default_rng(5)
    A, B = rng.normal(size=(6, 4)), rng.normal(size=(4, 3))

    def cells(m):
        return spark.createDataFrame([(i, j, float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])],
                                     "i long, j long, v double")
    out = np.zeros((6, 3))
    for r in la.cells_matmul(cells(A), cells(B), B.size).collect():
        out[r["i"], r["j"]] = r["v"]
    assert np.allclose(out, A @ B)


def test_gradient_sum_over_tasks_equals_one_task(spark):
    rng = np.random.default_rng(6)
    model = Sequential((4,), [Dense(3, "softmax")], seed=2)
    x, y = rng.normal(size=(30, 4)), np.eye(3)[rng.integers(0, 3, 30)]
    df = spark.createDataFrame([(x[i].tolist(), y[i].tolist()) for i in range(30)],
                               "x array<double>, y array<double>").repartition(5)
    direct = sc.collect_gradient(sc.gradient_sums(df.coalesce(1), model, "categorical_crossentropy", "accuracy"), 15)
    grouped = sc.collect_gradient(sc.gradient_sums(df, model, "categorical_crossentropy", "accuracy"), 15)
    assert np.allclose(direct[0], grouped[0]) and direct[1:] == pytest.approx(grouped[1:])


def test_large_gram_uses_numpy_partials(spark):
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(50, 70)), rng.normal(size=(50, 60))      # 4,200 cells > EXPR_CELLS
    df = spark.createDataFrame([(x[i].tolist(), y[i].tolist()) for i in range(50)],
                               "x array<double>, y array<double>").repartition(3)
    assert np.allclose(la.rows_gram(df, 70, 60), x.T @ y)


def test_five_digit_md5_buckets_keep_positions(spark, monkeypatch):
    import tessera.operators.split as sp
    df = spark.range(300).withColumnRenamed("id", "row_id")
    base = {r["row_id"]: r["pos"] for r in sp.shuffle_positions(df, "row_id", 5).collect()}
    monkeypatch.setattr(pos, "TARGET_BUCKET_ROWS", 0)       # any known count selects 5 digits
    assert pos.prefix_digits(300) == 5
    five = {r["row_id"]: r["pos"] for r in sp.shuffle_positions(df, "row_id", 5, n=300).collect()}
    assert five == base
