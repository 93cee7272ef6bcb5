"""Gradients, optimizer updates, training and early stopping."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.numeric import r4
from tessera.operators.model import AvgPool2D, Conv2D, Dense, Flatten, Sequential
from tessera.operators.optim import new_optimizer
from tessera.operators.score import collect_gradient, gradient_sums
from tessera.operators.train import EarlyStopping, early_stop_frame, fit
from tessera.registry.base import R, R6, query, r6, tbl
from tessera.registry.model_q import CNN_GRAD_SQL, X_SQL, cnn, emb_dataset, emb_rows, mlp


def w_dense():
    return np.array([[((i * 7 + j * 3) % 11 - 5) / 50.0 for j in range(10)] for i in range(64)])


def b_dense():
    return np.array([((j % 3) - 1) / 10.0 for j in range(10)])


def softmax_layer() -> Sequential:
    return Sequential((64,), [Dense(10, "softmax")], seed=0, params=[{"w": w_dense(), "b": b_dense()}])


def gradient_frame(spark, sf, model, loss="categorical_crossentropy"):
    """Mean gradient over the whole table as (layer, param, idx, g)."""
    sums = gradient_sums(emb_rows(spark, sf), model, loss, None)
    g, n, _, _ = collect_gradient(sums, len(model.flat()))           # model-sized
    rows, pos = [], 0
    for li, p in enumerate(model.params):
        for k in ("w", "b"):
            if k in p:
                for i in range(p[k].size):
                    rows.append((li, k, i, float(g[pos] / n)))
                    pos += 1
    return spark.createDataFrame(rows, "layer long, param string, idx long, g double")


GRAD_SQL = f"""{X_SQL},
w AS (SELECT i AS k, j, ((i * 7 + j * 3) % 11 - 5) / 50.0 AS w FROM range(64) t(i), range(10) s(j)),
b AS (SELECT j, ((j % 3) - 1) / 10.0 AS b FROM range(10) s(j)),
z AS (SELECT x.vec_id, w.j, sum(x.v * w.w) + max(b.b) AS z FROM x JOIN w ON x.k = w.k JOIN b ON w.j = b.j
      GROUP BY x.vec_id, w.j),
zm AS (SELECT vec_id, max(z) AS mx FROM z GROUP BY vec_id),
ez AS (SELECT z.vec_id, z.j, exp(z.z - zm.mx) AS e FROM z JOIN zm ON z.vec_id = zm.vec_id),
es AS (SELECT vec_id, sum(e) AS s FROM ez GROUP BY vec_id),
d AS (SELECT ez.vec_id, ez.j, ez.e / es.s - CASE WHEN em.label = ez.j THEN 1.0 ELSE 0.0 END AS d
      FROM ez JOIN es ON ez.vec_id = es.vec_id JOIN embeddings em ON em.vec_id = ez.vec_id),
n AS (SELECT count(*) AS n FROM embeddings),
grad AS (
  SELECT 'w' AS param, x.k * 10 + d.j AS idx, sum(x.v * d.d) / (SELECT n FROM n) AS g
  FROM x JOIN d ON x.vec_id = d.vec_id GROUP BY x.k, d.j
  UNION ALL
  SELECT 'b', d.j, sum(d.d) / (SELECT n FROM n) FROM d GROUP BY d.j),
p0 AS (SELECT 'w' AS param, k * 10 + j AS idx, w FROM w UNION ALL SELECT 'b', j, b FROM b),
s0 AS (SELECT p0.param, p0.idx, p0.w, grad.g FROM p0 JOIN grad ON p0.param = grad.param AND p0.idx = grad.idx)"""


@query("gradient_dense", f"""
WITH {GRAD_SQL}
SELECT CAST(0 AS BIGINT) AS layer, param, CAST(idx AS BIGINT) AS idx, {R6('g')} AS g FROM grad
""")
def q_gradient_dense(spark, sf):
    gf = gradient_frame(spark, sf, softmax_layer())
    return gf.select("layer", "param", "idx", r6("g").alias("g"))


@query("gradient_conv", CNN_GRAD_SQL)
def q_gradient_conv(spark, sf):
    gf = gradient_frame(spark, sf, cnn())
    return gf.select("layer", "param", "idx", r6("g").alias("g"))


# two optimizer steps with the gradient of the whole table
OPTS = {
    "opt_sgd": dict(name="SGD", learning_rate=0.1, momentum=0.9),
    "opt_adagrad": dict(name="Adagrad", learning_rate=0.1),
    "opt_rmsprop": dict(name="RMSProp", learning_rate=0.01, momentum=0.5, rho=0.9),
    "opt_adadelta": dict(name="Adadelta", learning_rate=1.0, rho=0.95),
    "opt_adam": dict(name="Adam", learning_rate=0.01),
}


def _sql_step(o, src: str, t: int) -> str:
    """One update as SQL over (param, idx, w, g, v, acc, d)."""
    lr, eps = o.learning_rate, o.epsilon
    if o.name == "SGD":
        return (f"SELECT param, idx, g, w - ({o.momentum} * v + {lr} * g) AS w, "
                f"{o.momentum} * v + {lr} * g AS v, acc, d FROM {src}")
    if o.name == "Adagrad":
        return (f"SELECT param, idx, g, w - {lr} * g / sqrt(acc + g * g + {eps}) AS w, v, "
                f"acc + g * g AS acc, d FROM {src}")
    if o.name == "RMSProp":
        a = f"({o.rho} * acc + (1 - {o.rho}) * g * g)"
        v = f"({o.momentum} * v + {lr} * g / sqrt({a} + {eps}))"
        return f"SELECT param, idx, g, w - {v} AS w, {v} AS v, {a} AS acc, d FROM {src}"
    if o.name == "Adadelta":
        a = f"({o.rho} * acc + (1 - {o.rho}) * g * g)"
        u = f"({lr} * g * sqrt((d + {eps}) / ({a} + {eps})))"
        return (f"SELECT param, idx, g, w - {u} AS w, v, {a} AS acc, "
                f"{o.rho} * d + (1 - {o.rho}) * {u} * {u} AS d FROM {src}")
    m = f"({o.beta_1} * v + (1 - {o.beta_1}) * g)"
    a = f"({o.beta_2} * acc + (1 - {o.beta_2}) * g * g)"
    return (f"SELECT param, idx, g, w - {lr} * ({m} / {1 - o.beta_1 ** t}) / "
            f"(sqrt({a} / {1 - o.beta_2 ** t}) + {eps}) AS w, {m} AS v, {a} AS acc, d FROM {src}")


def _opt_query(qname, cfg):
    o = new_optimizer(**cfg)
    sql = f"""
WITH {GRAD_SQL},
st0 AS (SELECT param, idx, g, w, 0.0 AS v, {o.initial_accumulator} AS acc, 0.0 AS d FROM s0),
st1 AS ({_sql_step(o, 'st0', 1)}),
st2 AS ({_sql_step(o, 'st1', 2)})
SELECT CAST(0 AS BIGINT) AS layer, param, CAST(idx AS BIGINT) AS idx, {R6('w')} AS w FROM st2"""

    @query(qname, sql)
    def run(spark, sf):
        opt = new_optimizer(**cfg)
        model = softmax_layer()
        grads = gradient_frame(spark, sf, model)
        params = spark.createDataFrame(list(model.param_rows()), "layer long, param string, idx long, w double")
        cur = params.join(grads, ["layer", "param", "idx"]).select(
            "layer", "param", "idx", "w", "g", F.lit(0.0).alias("v"),
            F.lit(float(opt.initial_accumulator)).alias("acc"), F.lit(0.0).alias("d"))
        for t in (1, 2):
            new = opt.update_columns(F.col("w"), F.col("g"), F.col("v"), F.col("acc"), F.col("d"), t)
            cur = cur.select("layer", "param", "idx", "g", *[new[k].alias(k) for k in ("w", "v", "acc", "d")])
        return cur.select("layer", "param", "idx", r6("w").alias("w"))
    return run


for _name, _cfg in OPTS.items():
    _opt_query(_name, _cfg)


@query("train_mlp")
def q_train_mlp(spark, sf):
    model = mlp()
    opt = new_optimizer("Adam", learning_rate=0.01)
    _, hist = fit(model, emb_dataset(spark, sf), opt, "categorical_crossentropy", "accuracy",
                  epochs=3, batch_size=128, validation_split=0.2,
                  early_stopping=EarlyStopping("val_loss", patience=2, restore_best_weights=True), seed=3)
    return hist


@query("train_cnn")
def q_train_cnn(spark, sf):
    """The reference demo's network shape on 8x8 images: conv, average pool,
    conv, average pool, dense 120 / 84 / 10; SGD with Nesterov momentum."""
    model = Sequential((1, 8, 8), [
        Conv2D(6, (3, 3), (1, 1), (1, 1), "relu"), AvgPool2D((2, 2), (2, 2)),
        Conv2D(16, (3, 3), (1, 1), (1, 1), "relu"), AvgPool2D((2, 2), (2, 2)),
        Flatten(), Dense(120, "relu"), Dense(84, "relu"), Dense(10, "softmax")], seed=9)
    opt = new_optimizer("SGD", learning_rate=0.01, momentum=0.9, nesterov=True)
    _, hist = fit(model, emb_dataset(spark, sf), opt, "categorical_crossentropy", "categorical_accuracy",
                  epochs=2, batch_size=256, validation_split=0.2,
                  early_stopping=EarlyStopping("val_loss", patience=15), seed=11)
    return hist


HIST_SQL = """h0 AS (SELECT CAST(ts AS DATE) AS day, avg(value) AS v FROM events GROUP BY 1),
h AS (SELECT row_number() OVER (ORDER BY day) AS epoch, v FROM h0),
f AS (SELECT epoch, v, (lag(v) OVER (ORDER BY epoch) IS NULL OR v <= lag(v) OVER (ORDER BY epoch)) AS imp FROM h),
g AS (SELECT *, max(CASE WHEN imp THEN epoch END) OVER (ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS li FROM f),
b AS (SELECT *, sum(CASE WHEN imp THEN 0 ELSE 1 END)
                 OVER (PARTITION BY li ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS bad FROM g),
s AS (SELECT min(epoch) AS stop_epoch FROM b WHERE bad >= 2),
c AS (SELECT b.* FROM b, s WHERE imp AND (s.stop_epoch IS NULL OR epoch <= s.stop_epoch))"""


@query("early_stop_history", f"""
WITH {HIST_SQL}
SELECT CAST((SELECT stop_epoch FROM s) AS BIGINT) AS stop_epoch,
       CAST(arg_min(epoch, (v, epoch)) AS BIGINT) AS best_epoch, {R('min(v)')} AS best_value
FROM c
""")
def q_early_stop_history(spark, sf):
    ev = tbl(spark, sf, "events", ["ts", "value"])
    daily = ev.groupBy(F.to_date("ts").alias("day")).agg(F.avg("value").alias("v"))
    # one row per day: numbering the aggregated history is bounded
    hist = daily.select(F.row_number().over(Window.orderBy("day")).alias("epoch"), "v")
    out = early_stop_frame(hist, "epoch", "v", lower_is_better=True, min_delta=0.0, patience=2)
    return out.select("stop_epoch", "best_epoch", r4("best_value").alias("best_value"))
