"""Training loop, evaluation and early stopping.

Steps follow each other, whatever runs them: each needs the weights of the one
before. Mini-batches above ``CHAIN_ROWS`` rows take one Spark job a step, whose
gradient all executors sum (see ``operators.score.gradient_sums``). Smaller ones
have no work to share out, so a job takes a stretch of about ``CHAIN_ROWS`` rows
of them and its one task makes their steps one after the other, holding one
mini-batch; weights and optimizer state go on to the next job. So the jobs grow
with the rows and not with the steps, and no task sees more than a stretch. The
driver holds only model-sized arrays. Each epoch's mini-batch numbering is
written once to the shared folder, in a folder for each stretch (else sorted by
batch), so that every job reads its own rows only and a lost executor only
recomputes from that written table.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import metrics as M
from tessera.operators.dataset import Dataset
from tessera.operators.model import Sequential, check_loss_pair, layer_masks
from tessera.operators.optim import Optimizer
from tessera.operators.score import (batch_gradient, collect_gradient, gradient_sums, list_to_np,
                                     np_to_list, predict)
from tessera.operators.split import round_half_away, train_test_split, with_batches
from tessera.session import remove_scratch, scratch_path

# Monitored quantities (even index: lower is better).
MONITORS = ("loss", "accuracy", "val_loss", "val_accuracy")

CHAIN_ROWS = 1 << 15        # rows whose mini-batches one task steps through
STATE = ("v", "acc", "d")   # arrays of an optimizer's state, each as long as the weights


@dataclass
class EarlyStopping:
    monitor: str = "loss"
    min_delta: float = 0.0
    patience: int = 1
    restore_best_weights: bool = False

    def __post_init__(self):
        if self.monitor not in MONITORS:
            raise ValueError(f"unknown monitor {self.monitor!r}")
        if self.patience < 1:
            raise ValueError("patience must be >= 1")
        self.min_delta = max(0.0, self.min_delta)

    @property
    def lower_is_better(self) -> bool:
        return MONITORS.index(self.monitor) % 2 == 0


class EarlyStopState:
    """Compares every epoch with the previous one; reset per fit."""

    def __init__(self, es: EarlyStopping):
        self.es = es
        self.last = np.inf if es.lower_is_better else -np.inf
        self.best = self.last
        self.best_epoch = 0
        self.count = 0

    def update(self, value: float, epoch: int) -> tuple[bool, bool]:
        """(stop, new_best) after observing ``value`` at ``epoch``."""
        es, new_best = self.es, False
        worse = (value > self.last - es.min_delta) if es.lower_is_better else (value < self.last + es.min_delta)
        if worse:
            self.count += 1
        else:
            self.count = 0
            better = value < self.best if es.lower_is_better else value > self.best
            if better:
                self.best, self.best_epoch, new_best = value, epoch, True
        if self.count >= es.patience:
            return True, new_best
        self.last = value
        return False, new_best


def early_stop_frame(history: DataFrame, epoch: str, value: str, lower_is_better: bool = True,
                     min_delta: float = 0.0, patience: int = 1) -> DataFrame:
    """Early-stopping decision over a history table as one windowed query:
    (stop_epoch, best_epoch, best_value). The history has one row per epoch
    (bounded by the epoch count), so its un-partitioned windows are small."""
    w = Window.orderBy(epoch)
    prev = F.lag(value).over(w)
    if lower_is_better:
        improved = prev.isNull() | (F.col(value) <= prev - F.lit(min_delta))
    else:
        improved = prev.isNull() | (F.col(value) >= prev + F.lit(min_delta))
    h = history.select(epoch, value, improved.alias("_imp"))
    h = h.withColumn("_last_imp", F.max(F.when(F.col("_imp"), F.col(epoch))).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    h = h.withColumn("_bad", F.sum((~F.col("_imp")).cast("int")).over(
        Window.partitionBy("_last_imp").orderBy(epoch).rowsBetween(Window.unboundedPreceding, 0)))
    # the history is epochs-sized: an un-partitioned window over it is bounded
    whole = Window.partitionBy(F.lit(1))
    h = h.withColumn("_stop", F.min(F.when(F.col("_bad") >= patience, F.col(epoch))).over(whole))
    cand = h.where(F.col("_imp") & (F.col("_stop").isNull() | (F.col(epoch) <= F.col("_stop"))))
    order = F.struct(F.col(value) if lower_is_better else -F.col(value), F.col(epoch))
    return cand.agg(F.max("_stop").cast("long").alias("stop_epoch"),
                    F.min_by(F.col(epoch), order).cast("long").alias("best_epoch"),
                    F.min_by(F.col(value), order).alias("best_value"))


@dataclass
class Compiled:
    """A model with its optimizer (state initialised), loss and metric."""
    model: Sequential
    optimizer: Optimizer
    loss: str
    metric: str


def compile_model(model: Sequential, optimizer: Optimizer, loss: str, metric: str) -> Compiled:
    """Validate the loss/output pairing and the metric, and initialise the
    optimizer state (velocity 0, accumulator at its initial value)."""
    check_loss_pair(model, loss)
    if metric not in M.METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    M.check_output_rank(len(model.output_shape), metric)
    optimizer.init_state(len(model.flat()))
    return Compiled(model, optimizer, loss, metric)


def evaluate(model: Sequential, data: Dataset, loss: str, metric: str) -> DataFrame:
    """Forward pass over the whole table, loss and metric in one aggregate."""
    check_loss_pair(model, loss)
    outputs = int(np.prod(model.output_shape))
    rank = len(model.output_shape)
    M.check_output_rank(rank, loss)
    M.check_output_rank(rank, metric)
    pred = predict(data.df, model, key="row_id", x="x", keep=["y"])
    return M.evaluate_predictions(pred, loss, metric, outputs, rank=rank)


def _means(model: Sequential, loss: str, metric: str, n: float, lsum: float, msum: float) -> tuple[float, float]:
    """Loss and metric of a mini-batch from its sums."""
    outputs = int(np.prod(model.output_shape))
    per_element = len(model.output_shape) == 3
    return (lsum / (n * outputs if loss == "mse" or per_element else n),
            msum / (n * outputs if metric in ("mse", "mae") or (per_element and metric == "binary_accuracy") else n))


def chained_steps(df: DataFrame, model: Sequential, optimizer: Optimizer, w: np.ndarray, loss: str, metric: str,
                  seed: int, step: int) -> tuple[np.ndarray, list[float], list[float]]:
    """One step for each mini-batch of ``df`` (columns ``batch``, ``row_id``, ``x``,
    ``y``), in the order of ``batch``, as one task: weights after them, and the loss
    and metric of each. ``step`` steps were made before; the optimizer's state moves on."""
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast((model, optimizer, w))
    src = df.select("batch", "row_id", F.col("x").cast("array<double>").alias("x"),
                    F.col("y").cast("array<double>").alias("y"))
    src = src.coalesce(1).sortWithinPartitions("batch", "row_id").select("batch", "x", "y")

    def run(batches):
        m, opt, now = bc.value
        opt = replace(opt, state=dict(opt.state))
        at, waiting, losses, mets = None, [], [], []

        def stepped(now):
            xs, ys = (np.concatenate(c) for c in zip(*waiting))
            params, la = m.unflat(now), opt.lookahead(now)
            masks = layer_masks(m, seed, step + len(losses) + 1)
            g, lsum, msum = batch_gradient(m, params, xs, ys, loss, metric, masks,
                                           m.unflat(la) if la is not None else None)
            a, b = _means(m, loss, metric, len(xs), lsum, msum)
            losses.append(a)
            mets.append(b)
            return opt.step(now, g / len(xs))

        for b in batches:
            if not len(b):
                continue
            number = b.column(b.schema.get_field_index("batch")).to_numpy()
            xs, ys = (list_to_np(b.column(b.schema.get_field_index(c))) for c in ("x", "y"))
            cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(b)]
            for lo, hi in zip(cuts, cuts[1:]):
                if number[lo] != at:
                    now = stepped(now) if waiting else now
                    at, waiting = number[lo], []
                waiting.append((xs[lo:hi], ys[lo:hi]))
        if not waiting:
            return
        now = stepped(now)
        arrays = [now, np.array(losses), np.array(mets), *[opt.state[k] for k in STATE]]
        yield pa.RecordBatch.from_arrays([*[np_to_list(a.reshape(1, -1)) for a in arrays],
                                          pa.array([opt.state["t"]], pa.int64())],
                                         names=["w", "losses", "metrics", *STATE, "t"])

    schema = ", ".join(f"{c} array<double>" for c in ("w", "losses", "metrics", *STATE)) + ", t long"
    got = src.mapInArrow(run, schema).toArrow()                     # model-sized: one row
    bc.unpersist()
    one = {c: list_to_np(got.column(c))[0] for c in ("w", "losses", "metrics", *STATE)}
    optimizer.state = {**{k: one[k] for k in STATE}, "t": got.column("t")[0].as_py()}
    return one["w"], one["losses"].tolist(), one["metrics"].tolist()


def fit(model: Sequential, data: Dataset, optimizer: Optimizer, loss: str, metric: str,
        epochs: int = 1, batch_size: int = 0, validation_split: float = 0.0,
        val: Dataset | None = None, early_stopping: EarlyStopping | None = None,
        seed: int = 1) -> tuple[Sequential, DataFrame]:
    """Synchronous mini-batch training; returns the model and a history
    DataFrame (epoch, loss, metric, val_loss, val_metric)."""
    check_loss_pair(model, loss)
    M.check_output_rank(len(model.output_shape), loss)
    M.check_output_rank(len(model.output_shape), metric)
    spark = data.df.sparkSession
    train_df = data.df.select("row_id", "x", "y")
    n = None
    if val is None and validation_split > 0:
        vs = validation_split if validation_split < 1 else 0.2
        n_all = train_df.count()
        train_df, val_df = train_test_split(train_df, "row_id", vs, seed=epochs, n=n_all)
        n = n_all - round_half_away(vs * n_all)
        val = Dataset(val_df, data.features, data.shape, data.classes)
    # cut the lineage once: the prepared training rows live in the shared folder
    path = scratch_path(spark, "train")
    schema = train_df.schema
    train_df.write.mode("overwrite").parquet(path)
    train_df = spark.read.schema(schema).parquet(path)
    n = train_df.count() if n is None else n
    if n == 0:
        raise ValueError("no training rows")
    if batch_size <= 0 or batch_size >= n:
        batch_size = n
    n_batches = -(-n // batch_size)
    chained = CHAIN_ROWS // batch_size if n_batches > 1 else 0      # mini-batches a job steps through
    w = model.flat()
    optimizer.init_state(len(w))
    es = EarlyStopState(early_stopping) if early_stopping else None
    best_w = w.copy()
    history, step = [], 0
    scratch = [path]
    for epoch in range(1, epochs + 1):
        if n_batches == 1:
            batches = [train_df]
        else:
            if len(scratch) > 1:       # the previous epoch's batches are no longer read
                remove_scratch(spark, scratch.pop())
            bpath = scratch_path(spark, f"batches-e{epoch}")
            scratch.append(bpath)
            # each task writes whole coarse buckets, rows sorted by position
            # inside them: row groups cover narrow batch ranges, so a step
            # reading ``batch == b`` prunes the others by their statistics, and
            # a stretch of small batches has few files, in a folder of its own
            batched = with_batches(train_df, "row_id", seed * 100003 + epoch, batch_size, n=n)
            bschema = batched.schema
            if chained > 1:
                batched = batched.withColumn("stretch", F.floor(F.col("batch") / chained).cast("long"))
                batched.write.mode("overwrite").partitionBy("stretch").parquet(bpath)
                bt = spark.read.schema(bschema.add("stretch", "long")).parquet(bpath)
                batches = [bt.where(F.col("stretch") == s) for s in range(-(-n_batches // chained))]
            else:
                batched.write.mode("overwrite").parquet(bpath)
                bt = spark.read.schema(bschema).parquet(bpath)
                batches = [bt.where(F.col("batch") == b) for b in range(n_batches)]
        losses, mets = [], []
        for bdf in batches:
            if chained > 1:
                w, more_losses, more_mets = chained_steps(bdf, model, optimizer, w, loss, metric, seed, step)
                step += len(more_losses)
                losses += more_losses
                mets += more_mets
                continue
            step += 1
            model.params = model.unflat(w)
            masks = layer_masks(model, seed, step)
            la = optimizer.lookahead(w)
            look = model.unflat(la) if la is not None else None
            bcs: list = []
            g, cnt, lsum, msum = collect_gradient(
                gradient_sums(bdf, model, loss, metric, masks, look, broadcasts=bcs), len(w))
            for bc in bcs:
                bc.unpersist()
            one_loss, one_met = _means(model, loss, metric, cnt, lsum, msum)
            losses.append(one_loss)
            mets.append(one_met)
            w = optimizer.step(w, g / cnt)
        model.params = model.unflat(w)
        row = {"epoch": epoch, "loss": float(np.mean(losses)), "metric": float(np.mean(mets)),
               "val_loss": None, "val_metric": None}
        if val is not None:
            r = evaluate(model, val, loss, metric).collect()[0]
            row["val_loss"], row["val_metric"] = r["loss"], r["metric"]
        history.append(row)
        if es is not None:
            key = {"loss": "loss", "accuracy": "metric", "val_loss": "val_loss",
                   "val_accuracy": "val_metric"}[es.es.monitor]
            stop, new_best = es.update(row[key], epoch)
            if new_best:
                best_w = w.copy()
            if stop:
                break
    if es is not None and es.es.restore_best_weights:
        model.params = model.unflat(best_w)
    for old in scratch:
        remove_scratch(spark, old)
    hist = spark.createDataFrame(
        [(h["epoch"], h["loss"], h["metric"], h["val_loss"], h["val_metric"]) for h in history],
        "epoch long, loss double, metric double, val_loss double, val_metric double")
    return model, hist
