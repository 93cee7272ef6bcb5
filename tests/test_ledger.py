"""One test per semantics decision (SURVEY ledger D#) that changes a visible result."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import activations as act
from tessera.functions.missing import parse_double
from tessera.operators import encode, linalg as la, metrics as M, split
from tessera.operators.dataset import Dataset, to_dataset
from tessera.operators.impute import fit_imputer
from tessera.operators.model import Conv2D, Dense, Sequential
from tessera.operators.optim import new_optimizer
from tessera.operators.score import collect_gradient, gradient_sums
from tessera.operators.train import EarlyStopping, fit
from tessera.sources.csv import make_csv, read_csv


def test_d2_d3_missing_and_unparsable_become_null(spark):
    df = spark.createDataFrame([("12abc",), ("NaN",), ("3.5",), ("",)], "s string")
    got = [r[0] for r in df.select(parse_double(F.col("s"))).collect()]
    assert got == [None, None, 3.5, None]


def test_d4_type_from_all_rows(spark, tmp_path):
    p = tmp_path / "d4.csv"
    p.write_text("a,b\nNA,x\n1e5,2\n7,y\n")
    t = read_csv(spark, str(p))
    assert t.numeric == ["a"] and t.strings == ["b"]


def test_d8_writer_keeps_names_and_strings(spark, tmp_path):
    df = spark.createDataFrame([(0, "u", 1.5), (1, None, None)], "row_id long, s string, x double")
    out = str(tmp_path / "d8")
    make_csv(df.select("row_id", "s", "x"), out, numeric=["x"], strings=["s"])
    back = read_csv(spark, out)
    assert back.numeric == ["x"] and back.strings == ["s"]
    assert [tuple(r) for r in back.df.orderBy("row_id").collect()] == [(0, "u", 1.5), (1, None, None)]


def test_d13_d14_imputer(spark):
    df = spark.createDataFrame([(1.0, None), (None, "a")], "x double, s string")
    with pytest.raises(ValueError):
        fit_imputer(df, ["x"], "max")
    imp = fit_imputer(df, ["x"], "constant", None, ["s"], "constant", None)
    assert [tuple(r) for r in imp.transform(df).collect()] == [(1.0, None), (None, "a")]


def test_d17_d18_d19_codes(spark):
    df = spark.createDataFrame([(0, "z"), (1, None), (2, "a"), (3, "z")], "row_id long, s string")
    d = encode.fit_dictionary(df, encode.category_key(F.col("s")))
    assert d.codes() == {"z": 0, "nan": 1, "a": 2}
    new = spark.createDataFrame([(9, "q")], "row_id long, s string")
    enc = encode.one_hot_encode(new, encode.category_key(F.col("s")), d, "oh")
    r = encode.label_encode(new, encode.category_key(F.col("s")), d).collect()[0]
    assert r["code"] == -1 and enc.collect()[0]["oh"] == [0.0, 0.0, 0.0]


def test_d20_exact_numeric_keys(spark):
    df = spark.createDataFrame([(0, 123.0), (1, 1234.0), (2, -1.0), (3, 0.0)], "row_id long, y double")
    d = encode.fit_dictionary(df, encode.numeric_key(F.col("y")))
    assert d.size == 4


def test_d21_d22_targets(spark):
    df = spark.createDataFrame([(0, 1.0, 2.5), (1, 2.0, 3.5)], "row_id long, a double, t double")
    ds = to_dataset(df, "t", numeric=["a", "t"], strings=[], task="regression")
    assert sorted(tuple(r["y"]) for r in ds.df.collect()) == [(2.5,), (3.5,)]
    with pytest.raises(ValueError):
        to_dataset(df, "nope", numeric=["a", "t"], strings=[])


def test_d23_seeded_and_reproducible(spark):
    df = spark.range(50).withColumnRenamed("id", "row_id")
    a = {r["row_id"]: r["pos"] for r in split.shuffle_positions(df, "row_id", 3).collect()}
    b = {r["row_id"]: r["pos"] for r in split.shuffle_positions(df.repartition(4), "row_id", 3).collect()}
    c = {r["row_id"]: r["pos"] for r in split.shuffle_positions(df, "row_id", 4).collect()}
    assert a == b and a != c and sorted(a.values()) == list(range(50))


def test_d28_softmax_jvp_and_mse(spark):
    # softmax output trained with mse: gradient must not vanish
    rng = np.random.default_rng(2)
    model = Sequential((3,), [Dense(2, "softmax")], seed=2)
    x, y = rng.normal(size=(8, 3)), rng.normal(size=(8, 2))
    df = spark.createDataFrame([(x[i].tolist(), y[i].tolist()) for i in range(8)], "x array<double>, y array<double>")
    g, n, _, _ = collect_gradient(gradient_sums(df, model, "mse", None), len(model.flat()))
    assert np.abs(g).max() > 0
    a = spark.createDataFrame([([0.2, 0.8], [1.0, -1.0])], "a array<double>, g array<double>")
    jvp = a.select(act.softmax_jvp(F.col("a"), F.col("g")).alias("j")).collect()[0]["j"]
    assert jvp == pytest.approx([0.2 * (1 - (0.2 - 0.8)), 0.8 * (-1 - (0.2 - 0.8))])


def test_d32_adam_per_step_bias_correction():
    opt = new_optimizer("Adam", learning_rate=0.1)
    opt.init_state(1)
    w = opt.step(np.array([1.0]), np.array([0.5]))
    w = opt.step(w, np.array([0.5]))
    assert w[0] == pytest.approx(0.8, abs=1e-5)       # two full-size steps of lr


def test_d36_tensor_categorical_rejected():
    with pytest.raises(ValueError):
        M.check_output_rank(3, "categorical_crossentropy")


def test_d37_d38_early_stop_and_validation(spark):
    with pytest.raises(ValueError):
        EarlyStopping(patience=0)
    rows = [(i, [float(i % 3), 1.0], [1.0, 0.0] if i % 2 else [0.0, 1.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "row_id long, x array<double>, y array<double>")
    ds = Dataset(df, ["a", "b"], None, 2)
    val = Dataset(df.limit(5), ["a", "b"], None, 2)
    model = Sequential((2,), [Dense(2, "softmax")], seed=1)
    _, hist = fit(model, ds, new_optimizer("SGD", learning_rate=0.5), "categorical_crossentropy",
                  "accuracy", epochs=2, batch_size=8, validation_split=0.0, val=val)
    h = hist.collect()
    assert len(h) == 2 and all(r["val_loss"] is not None for r in h)


def test_d40_softplus_no_overflow(spark):
    df = spark.createDataFrame([(1000.0,), (-1000.0,)], "z double")
    got = [r[0] for r in df.select(act.softplus(F.col("z"))).collect()]
    assert got[0] == pytest.approx(1000.0) and got[1] == pytest.approx(0.0, abs=1e-300)
    assert all(math.isfinite(v) for v in got)


def test_d43_shape_checks_before_jobs(spark):
    a = spark.createDataFrame([(0, [1.0, 2.0])], "i long, x array<double>")
    with pytest.raises(ValueError):
        la.rows_elementwise(a, a, ["i"], "add", 2, 3)
    with pytest.raises(ValueError):
        la.rows_matmul_small(a, np.ones((3, 2)), 2)
    with pytest.raises(ValueError):
        Sequential((4,), [Dense(2), Conv2D(1, (2, 2))])


def test_compile_rejects_bad_pairs():
    from tessera.operators.train import compile_model
    m = Sequential((3,), [Dense(2, "sigmoid")], seed=1)
    with pytest.raises(ValueError):
        compile_model(m, new_optimizer("SGD"), "categorical_crossentropy", "accuracy")
    with pytest.raises(ValueError):
        compile_model(m, new_optimizer("SGD"), "binary_crossentropy", "auc")
    c = compile_model(m, new_optimizer("Adagrad"), "binary_crossentropy", "accuracy")
    assert np.allclose(c.optimizer.state["acc"], 0.1)


def test_d42_input_shape_checked(spark):
    from tessera.operators.model import Conv2D, forward
    m = Sequential((1, 3, 3), [Conv2D(1, (2, 2))], seed=1)
    with pytest.raises(ValueError):
        forward(m, m.params, np.ones((2, 8)))


def test_imputer_approximate_median_opt_in(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]] + [(None,)], "x double")
    assert fit_imputer(df, ["x"], "median").fill["x"] == 3.0
    assert fit_imputer(df, ["x"], "median", approx=True).fill["x"] == 3.0
