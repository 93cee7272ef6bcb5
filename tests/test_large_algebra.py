"""Tiled products, sparse vectors, key checks and splits of repeated keys."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import encode, linalg, sparse, split, tiles


def cells(spark, m):
    rows = [(int(i), int(j), float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1]) if m[i, j]]
    return spark.createDataFrame(rows, "i long, j long, v double").repartition(3)


def dense(df, shape):
    out = np.zeros(shape)
    for r in df.collect():
        assert out[r.i, r.j] == 0
        out[r.i, r.j] = r.v
    return out


@pytest.mark.parametrize("m, k, n", [(1, 1, 1), (9, 21, 17), (4, 40, 4), (30, 3, 11)])
def test_tiled_product(spark, monkeypatch, m, k, n):
    monkeypatch.setattr(tiles, "GROUP", 2)
    monkeypatch.setattr(tiles, "STRETCH", 3)
    rng = np.random.default_rng(m * n)
    a, b = rng.integers(-4, 5, (m, k)).astype(float), rng.integers(-4, 5, (k, n)).astype(float)
    out = tiles.cells_matmul_large(cells(spark, a), cells(spark, b), (m, k), (k, n), size=4)
    assert (dense(out, (m, n)) == a @ b).all()


def test_tiles_are_what_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr(tiles, "GROUP", 2)
    a = np.ones((16, 8))
    t = tiles.to_tiles(cells(spark, a), 16, 8, size=4)
    assert t.count() == 8
    plan = tiles.matmul(t, tiles.to_tiles(cells(spark, a.T), 8, 16, size=4), (16, 8), (8, 16), size=4)
    assert "CartesianProduct" not in plan._jdf.queryExecution().toString() and "Join" not in plan._jdf.queryExecution().toString()
    assert plan.count() == 16


def test_tiles_refuse_bad_cells(spark):
    one = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0)], "i long, j long, v double")
    with pytest.raises(Exception, match="given twice"):
        tiles.to_tiles(one, 2, 2).collect()
    with pytest.raises(Exception, match="shape mismatch"):
        tiles.to_tiles(spark.createDataFrame([(0, 5, 1.0)], "i long, j long, v double"), 2, 2).collect()
    with pytest.raises(ValueError, match="shape mismatch"):
        tiles.matmul(one, one, (2, 3), (2, 3))
    some = spark.createDataFrame([(0, 0, None), (1, 1, float("inf")), (0, 1, float("nan"))], "i long, j long, v double")
    got = {(r.i, r.j): r.v for r in tiles.to_cells(tiles.to_tiles(some, 2, 2, 2), 2, 2, 2).collect()}
    assert got[0, 0] == 0 == got[1, 0] and got[1, 1] == float("inf") and np.isnan(got[0, 1])
    none = spark.createDataFrame([], "i long, j long, v double")
    assert tiles.cells_matmul_large(none, none, (0, 0), (0, 0)).collect() == []


def test_a_million_classes_without_a_dense_row(spark):
    n = 1_000_000
    df = spark.range(n).select(F.col("id").alias("row_id"), F.concat(F.lit("c"), F.col("id")).alias("name"))
    codes = spark.range(n).select(F.concat(F.lit("c"), F.col("id")).alias("value"), F.col("id").cast("int").alias("code"))
    out = sparse.one_hot_encode(df, F.col("name"), encode.Dictionary(codes, n), "x")
    assert out.schema["x"].dataType.simpleString() == sparse.TYPE
    got = out.agg(F.sum(F.size("x.indices")), F.min("x.size"), F.count_if(F.col("x.indices")[0] == F.col("row_id"))).first()
    assert tuple(got) == (n, n, n)


def test_sparse_operations(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(-2, 3, (40, 12)).astype(float) * (rng.random((40, 12)) < 0.3)
    y = rng.integers(0, 9, (40, 3)).astype(float)
    df = spark.createDataFrame([(k, x[k].tolist(), y[k].tolist(), x[-1 - k].tolist()) for k in range(40)],
                               "key long, d array<double>, y array<double>, e array<double>")
    s = df.withColumn("x", sparse.from_dense(F.col("d"))).withColumn("z", sparse.from_dense(F.col("e")))
    rows = s.withColumn("back", sparse.to_dense(F.col("x"))).withColumn("dot", sparse.dot(F.col("x"), F.col("z"))) \
        .withColumn("twice", sparse.to_dense(sparse.scale(F.col("x"), 2.0))).collect()
    for r in rows:
        assert r.back == r.d and r.dot == float(np.dot(r.d, r.e)) and r.twice == [2 * v for v in r.d]
    b = rng.integers(-3, 4, (12, 5)).astype(float)
    right = spark.createDataFrame([(i, j, float(b[i, j])) for i in range(12) for j in range(5)], "i long, j long, v double")
    got = {(r.key, r.j): r.v for r in sparse.matmul(s, ["key"], "x", right, 60).collect()}
    want = x @ b
    assert all(got.get((k, j), 0.0) == want[k, j] for k in range(40) for j in range(5))
    got = {(r.i, r.j): r.v for r in sparse.gram(s, "x", "y").collect()}
    want = x.T @ y
    assert all(got.get((i, j), 0.0) == want[i, j] for i in range(12) for j in range(3))
    with pytest.raises(Exception, match="shape mismatch"):
        s.select(sparse.dot(F.col("x"), sparse.one_hot(F.lit(1), 3))).collect()


def test_unseen_classes_list_nothing(spark):
    v = spark.range(1).select(sparse.one_hot(F.lit(-1), 4).alias("a"), sparse.one_hot(F.lit(None).cast("int"), 4).alias("b"),
                              sparse.one_hot(F.lit(0), 0).alias("c")).first()
    assert [list(x.indices or []) for x in v] == [[], [], []] and v.c.size == 0


@pytest.mark.parametrize("rows_a, rows_b", [([(1, 2.0), (1, 3.0)], [(1, 5.0)]), ([(1, 2.0)], [(1, 5.0), (1, 5.0)]),
                                            ([(1, 2.0), (2, 1.0)], [(1, 5.0)])])
def test_elementwise_refuses_repeated_and_missing_keys(spark, rows_a, rows_b):
    def frame(rows):
        return spark.createDataFrame([(k, [v]) for k, v in rows], "i long, x array<double>")

    with pytest.raises(Exception, match="shape mismatch"):
        linalg.rows_elementwise(frame(rows_a), frame(rows_b), ["i"], "add", 1, 1).collect()
    with pytest.raises(Exception, match="shape mismatch"):
        linalg.cells_elementwise(*(linalg.rows_to_cells(frame(r), "i") for r in (rows_a, rows_b)), "mul").collect()


def test_elementwise_keeps_null_cells(spark):
    a = spark.createDataFrame([(1, 1, None), (1, 2, 3.0)], "i long, j long, v double")
    b = spark.createDataFrame([(1, 1, 4.0), (1, 2, 5.0)], "i long, j long, v double")
    assert {(r.j, r.v) for r in linalg.cells_elementwise(a, b, "add").collect()} == {(1, None), (2, 8.0)}


@pytest.mark.parametrize("size", [0.0, 0.25, 0.5, 0.77, 1.0])
def test_split_of_repeated_keys_is_exact(spark, monkeypatch, size):
    import tessera.plans.positions as p

    rows = [(k % 3, k % 7, "same") for k in range(20)] + [(1, 0, "same")] * 30 + [(None, 1, "x")] * 5
    df = spark.createDataFrame(rows, "key long, n long, t string").repartition(4)
    want = split.round_half_away(size * len(rows))
    monkeypatch.setattr(split, "COPIES", 7)
    seen = set()
    for final in (100_000, 2):
        monkeypatch.setattr(p, "FINAL_ROWS", final)
        train, test = split.train_test_split(df, "key", size, seed=9)
        a, b = Counter(map(tuple, train.collect())), Counter(map(tuple, test.collect()))
        assert sum(b.values()) == want and a + b == Counter(rows)
        labels = split.split_labels(df.repartition(2), "key", size, seed=9)
        assert Counter(tuple(r)[:3] for r in labels.where("split = 'test'").collect()) == b
        seen.add(tuple(sorted(b.items(), key=str)))
    assert len(seen) == 1


def test_split_of_one_row_many_times(spark):
    df = spark.range(20).select(F.lit(1).alias("key"))
    train, test = split.train_test_split(df, "key", 0.25, seed=1)
    assert (train.count(), test.count()) == (15, 5)


@pytest.mark.parametrize("rows, wa, wb, gaps", [(1, 1, 1, False), (37, 9, 22, True), (60, 21, 5, False)])
def test_wide_gram_in_tiles(spark, monkeypatch, rows, wa, wb, gaps):
    monkeypatch.setattr(tiles, "GROUP", 2)
    monkeypatch.setattr(tiles, "STRETCH", 2)
    monkeypatch.setattr(linalg, "GRAM_CELLS", 0)
    rng = np.random.default_rng(rows)
    a, b = rng.integers(-4, 5, (rows, wa)).astype(float), rng.integers(-4, 5, (rows, wb)).astype(float)
    if gaps:
        a[rng.random(a.shape) < 0.2] = np.nan
        a[:, 3] = np.nan                                 # NULL throughout
    data = [([None if np.isnan(v) else float(v) for v in p], [float(v) for v in q]) for p, q in zip(a, b)]
    df = spark.createDataFrame(data, "x array<double>, y array<double>").repartition(5)
    got = {(r.i, r.j): r.v for r in tiles.gram_tiles(df, wa, wb, size=4).collect()}
    known = (~np.isnan(a)).astype(float).T @ np.ones(b.shape)
    want = np.nan_to_num(a).T @ b
    assert got == {(i, j): want[i, j] if known[i, j] else None for i in range(wa) for j in range(wb)}
    same = {(r.i, r.j): r.v for r in linalg.gram_cells(df, wa, wb).collect()}
    assert same == got
    none = linalg.gram_cells(df.limit(0), wa, wb).collect()
    assert len(none) == wa * wb and all(r.v is None for r in none)


def test_gram_of_2500_columns(spark):
    df = spark.range(300, numPartitions=4).select(
        F.transform(F.sequence(F.lit(0), F.lit(2499)), lambda k: ((F.col("id") * 7 + k * 3) % 11).cast("double")).alias("x"))
    m = np.array([[(i * 7 + k * 3) % 11 for k in range(2500)] for i in range(300)], dtype=float)
    out = linalg.gram_cells(df, 2500, 2500, "x", "x")    # 6.25 million outputs
    r = out.agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.sum(F.col("v") * F.col("i")).alias("t")).first()
    want = m.T @ m
    assert (r.n, r.s, r.t) == (2500 * 2500, want.sum(), (want * np.arange(2500)[:, None]).sum())


def test_positions_over_many_range_partitions(spark):
    from tessera.plans.positions import positions_by_key
    df = spark.range(4000).select((F.col("id") * 37 % 4001).alias("k"), F.lit("x").alias("s")).repartition(5)
    out = positions_by_key(df, "k", rows_per_task=100)
    assert out.columns == ["k", "s", "pos"]
    rows = sorted(out.collect())
    assert [r.pos for r in rows] == list(range(4000))
    same = positions_by_key(df.withColumn("k", F.lit(7)), "k", rows_per_task=100)
    assert sorted(r.pos for r in same.collect()) == list(range(4000))


def test_dictionary_above_the_window_bound(spark, monkeypatch):
    monkeypatch.setattr(encode, "DICT_WINDOW_MAX", 10)
    df = spark.range(2000).select(F.col("id").alias("row_id"), (F.col("id") * 31 % 500).cast("string").alias("v"))
    d = encode.fit_dictionary(df.repartition(3), F.col("v"))
    assert dict(d.df.dtypes)["code"] == "bigint" and d.size == 500
    assert {r.value: r.code for r in d.df.collect()} == {str(k * 31 % 500): k for k in range(500)}
    out = encode.label_encode(df, F.col("v"), d)
    assert out.where(F.col("code") != F.col("row_id") % 500).isEmpty()
