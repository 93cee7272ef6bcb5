"""Algebraic identities, partition independence, skew and gradient checks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import linalg as la, split
from tessera.operators.model import (AvgPool2D, Conv2D, Dense, Flatten, MaxPool2D, Sequential,
                                     forward, layer_masks, loss_sum)
from tessera.operators.scale import fit_scaler
from tessera.operators.score import collect_gradient, gradient_sums
from tessera.plans.positions import kth_key, order_hash
from tessera.plans.quantile import column_stats, exact_medians, kth_values

from conftest import SF_SMALL


def test_exact_median_on_skewed_column(spark):
    # one value holds a third of the rows; the rest are spread out
    rng = np.random.default_rng(1)
    vals = np.concatenate([np.full(4000, 7.25), rng.normal(size=8000) * 100])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(5)
    got = exact_medians(df, ["x"])["x"]
    assert got == pytest.approx(float(np.median(vals)))
    ks = [0, 1, 3999, 6000, 11999]
    st = column_stats(df, ["x"])
    assert kth_values(df, [("x", k) for k in ks], st) == pytest.approx(list(np.sort(vals)[ks]))


def test_exact_median_many_rows_forces_refinement(spark, monkeypatch):
    import tessera.plans.quantile as q
    monkeypatch.setattr(q, "FINAL_ROWS", 50)
    vals = np.arange(1000, dtype=float) ** 1.5
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    assert q.exact_medians(df, ["x"])["x"] == pytest.approx(float(np.median(vals)))


def test_kth_key_refines_prefixes(spark, monkeypatch):
    import tessera.plans.positions as p
    monkeypatch.setattr(p, "FINAL_ROWS", 3)
    df = spark.range(500).withColumnRenamed("id", "k").withColumn("h", order_hash(9, "k"))
    rows = sorted((r["h"], r["k"]) for r in df.collect())
    for k in (0, 17, 250, 499):
        assert p.kth_key(df, "h", "k", k) == rows[k]


def test_split_partition_independent_and_exact(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    n = o.count()
    a = split.split_labels(o, "o_orderkey", 0.3, 42)
    b = split.split_labels(o.repartition(7), "o_orderkey", 0.3, 42)
    ta = {r[0] for r in a.where("split = 'test'").collect()}
    tb = {r[0] for r in b.where("split = 'test'").collect()}
    assert ta == tb and len(ta) == split.round_half_away(0.3 * n)
    pos = [r["pos"] for r in split.shuffle_positions(o.repartition(3), "o_orderkey", 42).collect()]
    assert sorted(pos) == list(range(n))
    g = split.gather(o, "o_orderkey", 42, 10, 25)
    assert g.count() == 15
    assert kth_key(o.withColumn("h", order_hash(42, "o_orderkey")), "h", "o_orderkey", 0) is not None


def test_rot180_twice_is_identity_and_transpose_of_product(spark):
    rng = np.random.default_rng(3)
    A, B = rng.normal(size=(4, 3)), rng.normal(size=(3, 5))

    def cells(m):
        return spark.createDataFrame([(i, j, float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])],
                                     "i long, j long, v double")

    def dense(df, r, c):
        out = np.zeros((r, c))
        for row in df.collect():
            out[row["i"], row["j"]] = row["v"]
        return out

    a = cells(A)
    assert np.allclose(dense(la.cells_rot180(la.cells_rot180(a, 4, 3), 4, 3), 4, 3), A)
    ab_t = dense(la.cells_transpose(la.cells_matmul(a, cells(B), 15)), 5, 4)
    bt_at = dense(la.cells_matmul(la.cells_transpose(cells(B)), la.cells_transpose(a), 12), 5, 4)
    assert np.allclose(ab_t, bt_at) and np.allclose(ab_t, (A @ B).T)
    img = spark.createDataFrame([(list(map(float, range(18))),)], "x array<double>")
    twice = img.select(la.rot180_array(la.rot180_array(F.col("x"), (2, 3, 3)), (2, 3, 3)).alias("x"))
    assert twice.collect()[0]["x"] == list(map(float, range(18)))


def test_scaling_is_invertible(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey",
                                                                   "l_suppkey", "l_quantity")
    sc = fit_scaler(li, ["l_quantity"], "standard")
    back = sc.transform(li).select(
        (F.col("l_quantity") * F.lit(sc.b[0]) + F.lit(sc.a[0])).alias("q"), F.col("l_quantity").alias("z"))
    orig = sorted(r[0] for r in li.select("l_quantity").collect())
    assert np.allclose(sorted(r["q"] for r in back.collect()), orig)


def _numeric_grad(model, x, y, loss):
    w0 = model.flat()
    eps = 1e-6
    num = np.zeros_like(w0)

    def L(w):
        out = forward(model, model.unflat(w), x)
        if loss == "mse":
            return 0.5 * ((out - y) ** 2).sum() / len(x)
        return loss_sum(loss, out, y)[0] / len(x)

    for i in range(len(w0)):
        e = np.zeros_like(w0)
        e[i] = eps
        num[i] = (L(w0 + e) - L(w0 - e)) / (2 * eps)
    return num


@pytest.mark.parametrize("kind", ["mlp", "cnn", "mse"])
def test_analytic_gradient_matches_numeric(spark, kind):
    rng = np.random.default_rng(7)
    if kind == "mlp":
        model = Sequential((5,), [Dense(4, "tanh"), Dense(3, "softmax")], seed=3)
        x, loss = rng.normal(size=(12, 5)), "categorical_crossentropy"
        y = np.eye(3)[rng.integers(0, 3, 12)]
    elif kind == "mse":
        model = Sequential((5,), [Dense(4, "sigmoid"), Dense(2, "softplus")], seed=4)
        x, loss = rng.normal(size=(12, 5)), "mse"
        y = rng.normal(size=(12, 2))
    else:
        model = Sequential((2, 6, 6), [Conv2D(3, (3, 3), (2, 2), (1, 1), "relu"), AvgPool2D((2, 2), (1, 1), (1, 1)),
                                       Conv2D(2, (2, 2), (1, 1), (0, 0), "tanh"), MaxPool2D((2, 2), (2, 2), (1, 1)),
                                       Flatten(), Dense(3, "softmax")], seed=5)
        x, loss = rng.normal(size=(6, 72)), "categorical_crossentropy"
        y = np.eye(3)[rng.integers(0, 3, 6)]
    df = spark.createDataFrame([(x[i].tolist(), y[i].tolist()) for i in range(len(x))],
                               "x array<double>, y array<double>").repartition(3)
    g, n, _, _ = collect_gradient(gradient_sums(df, model, loss, None), len(model.flat()))
    assert n == len(x)
    assert np.allclose(g / n, _numeric_grad(model, x, y, loss), atol=1e-6, rtol=1e-4)


def test_dropout_mask_counts():
    model = Sequential((10,), [Dense(8, "relu", dropout=[0.25]), Dense(2, "softmax")], seed=1)
    m = layer_masks(model, seed=3, step=1)[0]
    assert (m == 0).sum() == 2 and np.allclose(m[m > 0], 1 / 0.75)
    assert layer_masks(model, seed=3, step=1)[0].tolist() == m.tolist()
    assert layer_masks(model, seed=3, step=2)[1] is None


def test_large_product_uses_numpy_kernel(spark):
    rng = np.random.default_rng(11)
    x, w = rng.normal(size=(40, 80)), rng.normal(size=(80, 70))     # 5,600 cells > EXPR_CELLS
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(40)], "i long, x array<double>")
    got = {r["i"]: r["x"] for r in la.rows_matmul_small(df, w, 80).collect()}
    assert np.allclose(np.array([got[i] for i in range(40)]), x @ w)


def test_rot_kernels_give_input_delta_for_stride_one():
    from tessera.operators.model import conv_backward, conv_forward, rot_kernels
    rng = np.random.default_rng(4)
    x, w = rng.normal(size=(2, 3, 6, 6)), rng.normal(size=(4, 3, 3, 3))
    dz = rng.normal(size=(2, 4, 4, 4))
    _, _, dx = conv_backward(x, w, dz, (1, 1), (0, 0))
    full = conv_forward(dz, rot_kernels(w), np.zeros(3), (1, 1), (2, 2))
    assert np.allclose(dx, full)
    assert np.allclose(rot_kernels(rot_kernels(w)), w)


def test_approximate_median_opt_in(spark):
    from tessera.operators.profile import mean_median
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_quantity", "l_extendedprice")
    exact = {r["column"]: r["median"] for r in mean_median(li, ["l_quantity", "l_extendedprice"]).collect()}
    approx = {r["column"]: r["median"] for r in mean_median(li, ["l_quantity", "l_extendedprice"], True).collect()}
    vals = sorted(r[0] for r in li.select("l_extendedprice").collect())
    lo, hi = vals[int(len(vals) * 0.49)], vals[int(len(vals) * 0.51)]
    assert approx["l_quantity"] == exact["l_quantity"] and lo <= approx["l_extendedprice"] <= hi


def test_tensor_output_bce_gradient_and_metrics(spark):
    """Conv output with sigmoid: binary cross-entropy and accuracy over every element."""
    from pyspark.sql import functions as F
    from tessera.operators import metrics as M
    rng = np.random.default_rng(9)
    model = Sequential((1, 5, 5), [Conv2D(2, (3, 3), (1, 1), (1, 1), "sigmoid")], seed=8)
    x = rng.normal(size=(7, 25))
    y = (rng.random(size=(7, 50)) > 0.5).astype(float)
    df = spark.createDataFrame([(x[i].tolist(), y[i].tolist()) for i in range(7)],
                               "x array<double>, y array<double>").repartition(2)
    g, n, lsum, msum = collect_gradient(gradient_sums(df, model, "binary_crossentropy", "binary_accuracy"),
                                        len(model.flat()))
    out = forward(model, model.params, x)
    p = np.clip(out, 1e-8, 1 - 1e-8)
    assert lsum == pytest.approx(float((-(y * np.log(p) + (1 - y) * np.log(1 - p))).sum()))
    assert msum == pytest.approx(float(((out > 0.5) == y).sum()))
    w0, eps = model.flat(), 1e-6
    def L(w):
        o = np.clip(forward(model, model.unflat(w), x), 1e-12, 1 - 1e-12)
        return (-(y * np.log(o) + (1 - y) * np.log(1 - o))).sum() / len(x)
    num = np.array([(L(w0 + e) - L(w0 - e)) / (2 * eps) for e in np.eye(len(w0)) * eps])
    assert np.allclose(g / n, num, atol=1e-6, rtol=1e-4)
    pred = spark.createDataFrame([(out[i].tolist(), y[i].tolist()) for i in range(7)],
                                 "p array<double>, y array<double>")
    r = pred.agg(M.loss_expr("binary_crossentropy", F.col("p"), F.col("y"), 3).alias("l"),
                 M.metric_expr("binary_accuracy", F.col("p"), F.col("y"), 50, 3).alias("m")).collect()[0]
    assert r["l"] == pytest.approx(lsum / y.size) and r["m"] == pytest.approx(msum / y.size)
    with pytest.raises(ValueError):
        M.metric_expr("accuracy", F.col("p"), F.col("y"), 50, 3)
