"""The training loop against a brute-force numpy trainer on a small fixture."""

import hashlib

import numpy as np
import pytest

from tessera.operators.dataset import Dataset
from tessera.operators.model import Dense, Sequential
from tessera.operators.optim import new_optimizer
from tessera.operators.train import EarlyStopping, fit


def _brute_force(x, y, w, b, epochs, batch, seed, lr, momentum):
    """Softmax regression, cce, SGD with momentum: batches are consecutive
    slices of the order of md5('{seed}:{row_id}')."""
    n = len(x)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    losses = []
    for epoch in range(1, epochs + 1):
        s = seed * 100003 + epoch
        order = sorted(range(n), key=lambda i: (hashlib.md5(f"{s}:{i}".encode()).hexdigest(), i))
        batch_losses = []
        for start in range(0, n, batch):
            idx = order[start:start + batch]
            xb, yb = x[idx], y[idx]
            z = xb @ w + b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            batch_losses.append(-(np.log(p + 1e-10) * yb).sum() / len(idx))
            gw, gb = xb.T @ (p - yb) / len(idx), (p - yb).sum(0) / len(idx)
            vw, vb = momentum * vw + lr * gw, momentum * vb + lr * gb
            w, b = w - vw, b - vb
        losses.append(np.mean(batch_losses))
    return w, b, losses


def test_fit_matches_brute_force(spark):
    rng = np.random.default_rng(12)
    n = 23
    x = rng.normal(size=(n, 3))
    y = np.eye(2)[rng.integers(0, 2, n)]
    df = spark.createDataFrame([(i, x[i].tolist(), y[i].tolist()) for i in range(n)],
                               "row_id long, x array<double>, y array<double>").repartition(3)
    model = Sequential((3,), [Dense(2, "softmax")], seed=4)
    w0, b0 = model.params[0]["w"].copy(), model.params[0]["b"].copy()
    trained, hist = fit(model, Dataset(df, ["a", "b", "c"], None, 2),
                        new_optimizer("SGD", learning_rate=0.3, momentum=0.5),
                        "categorical_crossentropy", "accuracy", epochs=3, batch_size=5, seed=2)
    w, b, losses = _brute_force(x, y, w0, b0, 3, 5, 2, 0.3, 0.5)
    assert np.allclose(trained.params[0]["w"], w) and np.allclose(trained.params[0]["b"], b)
    assert [r["loss"] for r in hist.orderBy("epoch").collect()] == pytest.approx(losses)


def test_early_stopping_restores_best(spark):
    rng = np.random.default_rng(13)
    x = rng.normal(size=(20, 2))
    y = np.eye(2)[rng.integers(0, 2, 20)]
    df = spark.createDataFrame([(i, x[i].tolist(), y[i].tolist()) for i in range(20)],
                               "row_id long, x array<double>, y array<double>")
    model = Sequential((2,), [Dense(2, "softmax")], seed=6)
    # a learning rate large enough to oscillate, so the loss stops improving
    _, hist = fit(model, Dataset(df, ["a", "b"], None, 2), new_optimizer("SGD", learning_rate=50.0),
                  "categorical_crossentropy", "accuracy", epochs=8,
                  early_stopping=EarlyStopping("loss", patience=1, restore_best_weights=True))
    h = [r["loss"] for r in hist.orderBy("epoch").collect()]
    assert len(h) < 8 and h[-1] > h[-2]
