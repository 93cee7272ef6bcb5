"""Batch scoring and data-parallel gradient sums over DataFrames.

Both are ``mapInArrow`` jobs: parameters travel once per executor as a
broadcast variable (model-sized), every Arrow batch of rows is pushed through
the numpy kernels of ``operators.model``. Scoring is narrow (no shuffle).
Gradients are summed per task and emitted as ``(idx, g)`` rows - one row per
parameter per task - so the only shuffle is a grouped sum whose output is the
size of the model, never of the data.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.model import (Sequential, backward, check_loss_pair, forward, loss_sum,
                                     metric_sum, output_delta)

# special slots of the gradient vector job
N_SLOT, LOSS_SLOT, METRIC_SLOT = -1, -2, -3


def list_to_np(col) -> np.ndarray:
    """Arrow list<double> column with equal-length rows -> (n, width) array."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if n == 0:
        return np.zeros((0, 0))
    offs = col.offsets.to_numpy()
    widths = np.diff(offs)
    w = int(widths[0])
    if not np.all(widths == w):
        raise ValueError("all rows must have the same number of features")
    vals = col.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return vals[offs[0]:offs[-1]].reshape(n, w)


def np_to_list(a: np.ndarray) -> pa.Array:
    n, w = a.shape
    offs = pa.array(np.arange(0, n * w + 1, w, dtype=np.int32) if n else np.zeros(1, np.int32))
    return pa.ListArray.from_arrays(offs, pa.array(np.ascontiguousarray(a, dtype=np.float64).ravel()))


def predict(df: DataFrame, model: Sequential, key: str = "row_id", x: str = "x",
            out: str = "y_pred", keep: list[str] | None = None) -> DataFrame:
    """Append model outputs for every row (no dropout)."""
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast((model, model.params))
    keep = [c for c in (keep or []) if c not in (key, x)]
    src = df.select(key, F.col(x).cast("array<double>").alias(x), *keep)
    fields = [f for f in src.schema.fields if f.name != x]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{out}` array<double>"

    def run(batches):
        m, params = bc.value
        for b in batches:
            xs = list_to_np(b.column(x))
            ys = forward(m, params, xs) if len(xs) else np.zeros((0, int(np.prod(m.output_shape))))
            cols = [b.column(f.name) for f in fields] + [np_to_list(ys)]
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields] + [out])

    return src.mapInArrow(run, schema)


def batch_gradient(model: Sequential, params, xs: np.ndarray, ys: np.ndarray, loss: str, metric: str | None,
                   masks=None, lookahead=None) -> tuple[np.ndarray, float, float]:
    """(flat gradient sum, loss sum, metric sum) over the rows of one array."""
    out, caches = forward(model, params, xs, masks, keep=True)
    delta = output_delta(model, loss, out, ys, caches[-1])
    grads = backward(model, params, caches, delta, lookahead)
    flat = np.concatenate([g[k].ravel() for g in grads for k in ("w", "b") if k in g])
    rank = len(model.output_shape)
    return flat, loss_sum(loss, out, ys, rank)[0], metric_sum(metric, out, ys, rank)[0] if metric else 0.0


def gradient_sums(df: DataFrame, model: Sequential, loss: str, metric: str | None,
                  masks=None, lookahead=None, x: str = "x", y: str = "y",
                  broadcasts: list | None = None) -> DataFrame:
    """``(idx, g)``: per-parameter gradient sums over all rows (idx >= 0, flat
    parameter order), the row count (idx -1), loss sum (-2) and metric sum
    (-3). Divide by the count once on the driver. The parameter broadcast is
    appended to ``broadcasts`` so a caller that has collected the result can
    release it."""
    check_loss_pair(model, loss)
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast((model, model.params, masks, lookahead, loss, metric))
    if broadcasts is not None:
        broadcasts.append(bc)
    src = df.select(F.col(x).cast("array<double>").alias("x"), F.col(y).cast("array<double>").alias("y"))

    def run(batches):
        m, params, mk, la, ls, mt = bc.value
        acc, n, lsum, msum = None, 0.0, 0.0, 0.0
        for b in batches:
            xs, ys = list_to_np(b.column("x")), list_to_np(b.column("y"))
            if len(xs) == 0:
                continue
            flat, one_loss, one_metric = batch_gradient(m, params, xs, ys, ls, mt, mk, la)
            acc = flat if acc is None else acc + flat
            n += len(xs)
            lsum += one_loss
            msum += one_metric
        if acc is None:
            return
        idx = np.concatenate([np.arange(len(acc), dtype=np.int64),
                              np.array([N_SLOT, LOSS_SLOT, METRIC_SLOT], dtype=np.int64)])
        g = np.concatenate([acc, [n, lsum, msum]])
        yield pa.RecordBatch.from_arrays([pa.array(idx), pa.array(g)], names=["idx", "g"])

    return src.mapInArrow(run, "idx long, g double").groupBy("idx").agg(F.sum("g").alias("g"))


def collect_gradient(sums: DataFrame, n_params: int) -> tuple[np.ndarray, float, float, float]:
    """Driver copy of the summed gradient (model-sized) and the counters;
    rows of the same ``idx`` (per-task partial sums) are added up."""
    rows = sums.toArrow() if hasattr(sums, "toArrow") else None
    if rows is not None:
        idx = rows.column("idx").to_numpy()
        val = rows.column("g").to_numpy()
    else:  # pragma: no cover
        got = sums.collect()
        idx = np.array([r["idx"] for r in got], dtype=np.int64)
        val = np.array([r["g"] for r in got], dtype=float)
    g = np.zeros(n_params)
    pos = idx >= 0
    np.add.at(g, idx[pos], val[pos])
    n = float(val[idx == N_SLOT].sum())
    lsum = float(val[idx == LOSS_SLOT].sum())
    msum = float(val[idx == METRIC_SLOT].sum())
    return g, n, lsum, msum
