"""Hand-computed answers (FIXTURES.md part 3)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import encode, linalg as la, metrics as M, profile, split
from tessera.operators.dataset import reorder_pixels
from tessera.operators.impute import fit_imputer
from tessera.operators.model import (AvgPool2D, Conv2D, MaxPool2D, Sequential)
from tessera.operators.optim import new_optimizer
from tessera.operators.scale import fit_scaler
from tessera.operators.score import predict
from tessera.operators.train import EarlyStopping, EarlyStopState, early_stop_frame
from tessera.sources.csv import read_csv

X1 = "id,height,city,t\n1,1.5,hanoi,a\n2,NA,hue,b\n3,2.5,?,a\n4,-4.0,hue,a\n"
X2 = "-5,1\n\n6,\n,8\n"


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_x1_mixed_csv(spark, tmp_path):
    t = read_csv(spark, _write(tmp_path, "x1.csv", X1))
    assert t.header
    assert t.numeric == ["id", "height"] and t.strings == ["city", "t"]
    d = {r["column"]: r for r in profile.describe_numeric(t.df, ["height"]).collect()}["height"]
    assert (d["count"], d["mean"], d["min"], d["max"]) == (3, 0.0, -4.0, 2.5)
    assert d["std"] == pytest.approx(3.5)
    assert profile.medians(t.df, ["height"])["height"] == pytest.approx(1.5)
    s = {r["column"]: r for r in profile.describe_string(t.df, ["city"]).collect()}["city"]
    assert (s["count"], s["unique"], s["top"], s["freq"]) == (3, 2, "hue", 2)
    assert encode.fit_dictionary(t.df, encode.category_key(F.col("t"))).codes() == {"a": 0, "b": 1}
    assert encode.fit_dictionary(t.df, encode.category_key(F.col("city"))).codes() == \
        {"hanoi": 0, "hue": 1, "nan": 2}
    assert fit_imputer(t.df, ["height"], "mean").fill["height"] == pytest.approx(0.0)
    assert fit_imputer(t.df, ["height"], "median").fill["height"] == pytest.approx(1.5)
    assert fit_imputer(t.df, strings=["city"]).fill["city"] == "hue"
    rows = [tuple(r) for r in t.df.orderBy("row_id").collect()]
    assert rows[1] == (1, 2.0, None, "hue", "b") and rows[2][3] is None


def test_x2_headerless_blank_line(spark, tmp_path):
    t = read_csv(spark, _write(tmp_path, "x2.csv", X2))
    assert not t.header and t.numeric == ["c0", "c1"]
    rows = [tuple(r) for r in t.df.orderBy("row_id").collect()]
    assert rows == [(0, -5.0, 1.0), (1, 6.0, None), (2, None, 8.0)]


def test_x3_negative_max_and_tie(spark):
    df = spark.createDataFrame([(-3.0, "b"), (-1.0, "a"), (-2.0, "b"), (None, "a")], "x double, s string")
    d = profile.describe_numeric(df, ["x"]).collect()[0]
    assert d["max"] == -1.0 and d["min"] == -3.0
    assert profile.describe_string(df, ["s"]).collect()[0]["top"] == "a"


def test_x4_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, None), (4.0, None)], "x double, c double")
    st = fit_scaler(df, ["x", "c"], "standard")
    assert st.a[0] == pytest.approx(2.5) and st.b[0] == pytest.approx(1.290994, abs=1e-6)
    xs = [r["x"] for r in st.transform(df).orderBy("x").collect()]
    assert xs == pytest.approx([-1.161895, -0.387298, 0.387298, 1.161895], abs=1e-6)
    assert {r["c"] for r in st.transform(df).collect()} == {None}
    mm = fit_scaler(df, ["x", "c"], "minmax")
    assert [r["x"] for r in mm.transform(df).orderBy("x").collect()] == pytest.approx([0, 1 / 3, 2 / 3, 1])
    assert {r["c"] for r in mm.transform(df).collect()} == {None}


def _cells(spark, m):
    return spark.createDataFrame([(i, j, float(m[i][j])) for i in range(len(m)) for j in range(len(m[0]))],
                                 "i long, j long, v double")


def _dense(df, r, c):
    out = np.zeros((r, c))
    for row in df.collect():
        out[row["i"], row["j"]] = row["v"]
    return out.tolist()


def test_x5_algebra(spark):
    A, B = [[1, 2], [3, 4]], [[5, 6], [7, 8]]
    a, b = _cells(spark, A), _cells(spark, B)
    assert _dense(la.cells_elementwise(a, b, "add"), 2, 2) == [[6, 8], [10, 12]]
    assert _dense(la.cells_elementwise(a, b, "sub"), 2, 2) == [[-4, -4], [-4, -4]]
    assert _dense(la.cells_elementwise(a, b, "mul"), 2, 2) == [[5, 12], [21, 32]]
    assert _dense(la.cells_matmul(a, b, 4), 2, 2) == [[19, 22], [43, 50]]
    assert _dense(la.cells_transpose(a), 2, 2) == [[1, 3], [2, 4]]
    assert _dense(la.cells_rot180(a, 2, 2), 2, 2) == [[4, 3], [2, 1]]
    rows = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "i long, x array<double>")
    got = {r["i"]: r["x"] for r in la.rows_matmul_small(rows, np.array(B, float), 2).collect()}
    assert got == {0: [19.0, 22.0], 1: [43.0, 50.0]}


def _window(spark, layer, params=None):
    m = Sequential((1, 3, 3), [layer], seed=0, params=params)
    df = spark.createDataFrame([(0, [float(v) for v in range(1, 10)])], "row_id long, x array<double>")
    out = predict(df, m).collect()[0]["y_pred"]
    c, h, w = m.output_shape
    return np.array(out).reshape(h, w).tolist()


def test_x6_windows(spark):
    k = {"w": np.array([[[[1.0, 0.0], [0.0, 1.0]]]]), "b": np.zeros(1)}
    assert _window(spark, Conv2D(1, (2, 2)), [k]) == [[6, 8], [12, 14]]
    assert _window(spark, MaxPool2D((2, 2))) == [[5, 6], [8, 9]]
    assert _window(spark, AvgPool2D((2, 2))) == [[3, 4], [6, 7]]
    assert _window(spark, MaxPool2D((2, 2), (2, 2), (1, 1))) == [[1, 3], [7, 9]]
    assert _window(spark, AvgPool2D((2, 2), (2, 2), (1, 1))) == [[0.25, 1.25], [2.75, 7]]


def test_x7_image_order(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],)], "x array<double>")
    assert df.select(reorder_pixels(F.col("x"), 2, 1, 2).alias("y")).collect()[0]["y"] == [1.0, 3.0, 2.0, 4.0]


def test_x8_losses(spark):
    df = spark.createDataFrame([([0.8, 0.2], [1.0, 0.0]), ([0.4, 0.6], [0.0, 1.0])], "p array<double>, y array<double>")
    p, y = F.col("p"), F.col("y")
    r = df.agg(M.mse(p, y).alias("mse"), M.mae(p, y).alias("mae"),
               M.categorical_crossentropy(p, y).alias("cce"), M.categorical_accuracy(p, y).alias("cacc"),
               M.binary_crossentropy(p, y).alias("bce"), M.binary_accuracy(p, y).alias("bacc")).collect()[0]
    assert r["mse"] == pytest.approx(0.1) and r["mae"] == pytest.approx(0.3)
    assert r["cce"] == pytest.approx(0.366985, abs=1e-6) and r["cacc"] == 1.0
    assert r["bce"] == pytest.approx(0.366985, abs=1e-6) and r["bacc"] == 1.0


@pytest.mark.parametrize("name,kw,expected", [
    ("Adagrad", dict(initial_accumulator=0.1), 0.915485),
    ("RMSProp", dict(rho=0.9), 0.683773),
    ("Adadelta", dict(rho=0.95), 0.999859),
    ("Adam", dict(beta_1=0.9, beta_2=0.999), 0.900000),
])
def test_x9_one_step(spark, name, kw, expected):
    opt = new_optimizer(name, learning_rate=0.1, epsilon=1e-7, **kw)
    opt.init_state(1)
    assert opt.step(np.array([1.0]), np.array([0.5]))[0] == pytest.approx(expected, abs=1e-6)
    df = spark.createDataFrame([(1.0, 0.5)], "w double, g double")
    cols = opt.update_columns(F.col("w"), F.col("g"), F.lit(0.0), F.lit(float(opt.initial_accumulator)),
                              F.lit(0.0), 1)
    assert df.select(cols["w"].alias("w")).collect()[0]["w"] == pytest.approx(expected, abs=1e-6)


def test_x9_sgd_momentum():
    opt = new_optimizer("SGD", learning_rate=0.1, momentum=0.9)
    opt.init_state(1)
    w = opt.step(np.array([1.0]), np.array([0.5]))
    assert w[0] == pytest.approx(0.95)
    assert opt.step(w, np.array([0.5]))[0] == pytest.approx(0.855)
    plain = new_optimizer("SGD", learning_rate=0.1)
    plain.init_state(1)
    assert plain.step(np.array([1.0]), np.array([0.5]))[0] == pytest.approx(0.95)


def test_x10_split(spark):
    df = spark.range(10).withColumnRenamed("id", "row_id")
    train, test = split.train_test_split(df, "row_id", 0.25, seed=5)
    tr, te = {r[0] for r in train.collect()}, {r[0] for r in test.collect()}
    assert len(te) == 3 and len(tr) == 7 and not (tr & te) and tr | te == set(range(10))
    train2, test2 = split.train_test_split(df.repartition(7), "row_id", 0.25, seed=5)
    assert {r[0] for r in test2.collect()} == te
    assert split.round_half_away(2.5) == 3


def test_x11_early_stop(spark):
    st = EarlyStopState(EarlyStopping("loss", 0.0, 2))
    hist = [1.0, 0.8, 0.9, 1.0, 0.7]
    stop_at = None
    for e, v in enumerate(hist, 1):
        stop, _ = st.update(v, e)
        if stop:
            stop_at = e
            break
    assert stop_at == 4 and st.best_epoch == 2
    h = spark.createDataFrame(list(enumerate(hist, 1)), "epoch long, v double")
    r = early_stop_frame(h, "epoch", "v", True, 0.0, 2).collect()[0]
    assert (r["stop_epoch"], r["best_epoch"], r["best_value"]) == (4, 2, 0.8)


def test_unknown_names_rejected():
    with pytest.raises(ValueError):
        new_optimizer("Nadam")
    with pytest.raises(ValueError):
        EarlyStopping("auc")
    with pytest.raises(ValueError):
        EarlyStopping("loss", patience=0)
    assert math.isclose(new_optimizer("SGD").learning_rate, 0.01)
    assert math.isclose(new_optimizer("Adadelta").rho, 0.95)


def test_preview_of_dataset_rows(spark):
    from tessera.sources.preview import preview
    df = spark.createDataFrame([(1, [1.0, None], 2.345), (0, [0.5, 1.25], None)],
                               "row_id long, x array<double>, v double")
    rows = [tuple(r) for r in preview(df, 5).collect()]
    assert rows == [(0, "0.50 1.25", "nan", 1), (1, "1.00 nan", "2.35", 2)] or \
        rows == [(0, "0.50 1.25", "nan", 1), (1, "1.00 nan", "2.34", 2)]


def test_split_dataset_keeps_metadata(spark):
    from tessera.operators.dataset import Dataset, split_dataset
    df = spark.createDataFrame([(i, [float(i)], [1.0]) for i in range(10)],
                               "row_id long, x array<double>, y array<double>")
    tr, te = split_dataset(Dataset(df, ["a"], (1, 1, 1), 1), 0.25, 5)
    assert te.count() == 3 and tr.count() == 7 and te.shape == (1, 1, 1) and tr.classes == 1
