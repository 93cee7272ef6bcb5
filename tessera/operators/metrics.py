"""Losses and metrics as aggregates over a prediction table.

Input: one row per sample with ``y_pred`` and ``y`` arrays. Every function
returns one aggregate expression (partial + final aggregation), so a whole
evaluation is a single ``agg``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names accepted by compile/evaluate.
LOSSES = ("mse", "binary_crossentropy", "categorical_crossentropy")
METRICS = ("accuracy", "mse", "mae", "binary_accuracy", "categorical_accuracy")


def _rowsum(a: Column, b: Column, fn) -> Column:
    return F.aggregate(F.zip_with(a, b, fn), F.lit(0.0), lambda acc, v: acc + v)


def mse(p: Column, y: Column) -> Column:
    return F.sum(_rowsum(p, y, lambda a, b: (a - b) * (a - b))) / F.sum(F.size(y))


def mae(p: Column, y: Column) -> Column:
    return F.sum(_rowsum(p, y, lambda a, b: F.abs(a - b))) / F.sum(F.size(y))


def binary_crossentropy(p: Column, y: Column) -> Column:
    """Uses output 0 only; predictions clamped to [1e-8, 1 - 1e-8]."""
    q = F.least(F.greatest(F.element_at(p, 1), F.lit(1e-8)), F.lit(1 - 1e-8))
    t = F.element_at(y, 1)
    return F.avg(-(t * F.log(q) + (F.lit(1.0) - t) * F.log(F.lit(1.0) - q)))


def binary_crossentropy_all(p: Column, y: Column) -> Column:
    """Tensor outputs: mean over every element (clamped as above)."""
    def bce(a, b):
        q = F.least(F.greatest(a, F.lit(1e-8)), F.lit(1 - 1e-8))
        return -(b * F.log(q) + (F.lit(1.0) - b) * F.log(F.lit(1.0) - q))
    return F.sum(_rowsum(p, y, bce)) / F.sum(F.size(y))


def binary_accuracy_all(p: Column, y: Column) -> Column:
    """Tensor outputs: share of elements with (p > 0.5) == y."""
    hits = _rowsum(p, y, lambda a, b: ((a > 0.5).cast("double") == b).cast("double"))
    return F.sum(hits) / F.sum(F.size(y))


def categorical_crossentropy(p: Column, y: Column) -> Column:
    per_row = _rowsum(p, y, lambda a, b: F.when(b == 1.0, -F.log(a + F.lit(1e-10))).otherwise(F.lit(0.0)))
    return F.sum(per_row) / F.count(F.lit(1))


def binary_accuracy(p: Column, y: Column) -> Column:
    hit = (F.element_at(p, 1) > 0.5).cast("double") == F.element_at(y, 1)
    return F.avg(hit.cast("double"))


def categorical_accuracy(p: Column, y: Column) -> Column:
    """y at the first arg-max of p."""
    return F.avg(F.element_at(y, F.array_position(p, F.array_max(p)).cast("int")))


def loss_expr(name: str, p: Column, y: Column, rank: int = 1) -> Column:
    """Loss aggregate; ``rank`` is the rank of the model output (1 or 3)."""
    check_output_rank(rank, name)
    if name == "binary_crossentropy" and rank == 3:
        return binary_crossentropy_all(p, y)
    if name == "mse":
        return mse(p, y)
    if name == "binary_crossentropy":
        return binary_crossentropy(p, y)
    if name == "categorical_crossentropy":
        return categorical_crossentropy(p, y)
    raise ValueError(f"unknown loss {name!r}")


def metric_expr(name: str, p: Column, y: Column, outputs: int, rank: int = 1) -> Column:
    """Metric aggregate; ``accuracy`` dispatches on the output count."""
    check_output_rank(rank, name)
    if name == "binary_accuracy" and rank == 3:
        return binary_accuracy_all(p, y)
    if name == "accuracy":
        name = "binary_accuracy" if outputs == 1 else "categorical_accuracy"
    fns = {"mse": mse, "mae": mae, "binary_accuracy": binary_accuracy,
           "categorical_accuracy": categorical_accuracy}
    if name not in fns:
        raise ValueError(f"unknown metric {name!r}")
    return fns[name](p, y)


def check_output_rank(rank: int, name: str) -> None:
    """Categorical losses/metrics (and the accuracy dispatch) are defined for
    vector outputs only."""
    if rank != 1 and name in ("categorical_crossentropy", "categorical_accuracy", "accuracy"):
        raise ValueError(f"{name} is not defined for tensor outputs")


def evaluate_predictions(df: DataFrame, loss: str, metric: str, outputs: int,
                         p: str = "y_pred", y: str = "y", rank: int = 1) -> DataFrame:
    """One-row DataFrame (loss, metric)."""
    return df.agg(loss_expr(loss, F.col(p), F.col(y), rank).alias("loss"),
                  metric_expr(metric, F.col(p), F.col(y), outputs, rank).alias("metric"))
