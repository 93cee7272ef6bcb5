"""Model layers, scoring, metrics and model IO.

Closed-form parameters (regenerated in SQL):
  W1[i, j] = ((7i + 3j) % 11 - 5) / 50    b1[j] = ((j % 3) - 1) / 10     (64 x 16, relu)
  W2[i, j] = ((5i + 2j) % 13 - 6) / 40    b2[j] = ((j % 4) - 1.5) / 10   (16 x 10, softmax)
  K[o, c, i, j] = ((5o + 3i + 2j) % 7 - 3) / 10, bk[o] = (o - 0.5) / 10  (conv 3x3)
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tessera.functions import activations as act
from tessera.functions.numeric import double_array_lit, r4
from tessera.operators import linalg as la
from tessera.operators import metrics as M
from tessera.operators.dataset import Dataset
from tessera.operators.model import (AvgPool2D, Conv2D, Dense, Flatten, MaxPool2D, Sequential,
                                     dropout_mask)
from tessera.operators.score import predict
from tessera.operators.train import evaluate
from tessera.registry.base import R, R6, query, tbl
from tessera.session import scratch_path
from tessera.sources.model_io import load_model, save_model


def w1():
    return np.array([[((i * 7 + j * 3) % 11 - 5) / 50.0 for j in range(16)] for i in range(64)])


def b1():
    return np.array([((j % 3) - 1) / 10.0 for j in range(16)])


def w2():
    return np.array([[((i * 5 + j * 2) % 13 - 6) / 40.0 for j in range(10)] for i in range(16)])


def b2():
    return np.array([((j % 4) - 1.5) / 10.0 for j in range(10)])


def kconv(o_n=2, c_n=1, k=3):
    return np.array([[[[((o * 5 + i * 3 + j * 2) % 7 - 3) / 10.0 for j in range(k)] for i in range(k)]
                      for _ in range(c_n)] for o in range(o_n)])


def bconv(o_n=2):
    return np.array([(o - 0.5) / 10.0 for o in range(o_n)])


def mlp() -> Sequential:
    return Sequential((64,), [Dense(16, "relu"), Dense(10, "softmax")], seed=0,
                      params=[{"w": w1(), "b": b1()}, {"w": w2(), "b": b2()}])


def emb_rows(spark, sf):
    e = tbl(spark, sf, "embeddings", ["vec_id", "embedding", "label"])
    y = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda j: (j == F.col("label")).cast("double"))
    return e.select(F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("x"),
                    y.alias("y"))


def emb_dataset(spark, sf) -> Dataset:
    return Dataset(emb_rows(spark, sf), [str(i) for i in range(64)], None, 10)


def cells(df, key="row_id", arr="y_pred"):
    return df.select(F.col(key).alias("vec_id"), F.posexplode(arr).alias("j", "v")) \
        .select("vec_id", F.col("j").cast("long").alias("j"), r4("v").alias("v"))


X_SQL = """x AS (SELECT vec_id, unnest(range(0, 64)) AS k, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings)"""
W1_SQL = "w1 AS (SELECT i AS k, j, ((i * 7 + j * 3) % 11 - 5) / 50.0 AS w FROM range(64) t(i), range(16) s(j))"
B1_SQL = "b1 AS (SELECT j, ((j % 3) - 1) / 10.0 AS b FROM range(16) s(j))"
W2_SQL = "w2 AS (SELECT i AS j, o, ((i * 5 + o * 2) % 13 - 6) / 40.0 AS w FROM range(16) t(i), range(10) s(o))"
B2_SQL = "b2 AS (SELECT o, ((o % 4) - 1.5) / 10.0 AS b FROM range(10) s(o))"
MLP_SQL = f"""{X_SQL}, {W1_SQL}, {B1_SQL}, {W2_SQL}, {B2_SQL},
h AS (SELECT x.vec_id, w1.j, greatest(sum(x.v * w1.w) + max(b1.b), 0) AS a
      FROM x JOIN w1 ON x.k = w1.k JOIN b1 ON w1.j = b1.j GROUP BY x.vec_id, w1.j),
z AS (SELECT h.vec_id, w2.o, sum(h.a * w2.w) + max(b2.b) AS z
      FROM h JOIN w2 ON h.j = w2.j JOIN b2 ON w2.o = b2.o GROUP BY h.vec_id, w2.o),
zm AS (SELECT vec_id, max(z) AS mx FROM z GROUP BY vec_id),
ez AS (SELECT z.vec_id, z.o, exp(z.z - zm.mx) AS e FROM z JOIN zm ON z.vec_id = zm.vec_id),
es AS (SELECT vec_id, sum(e) AS s FROM ez GROUP BY vec_id),
pred AS (SELECT ez.vec_id, ez.o, ez.e / es.s AS p FROM ez JOIN es ON ez.vec_id = es.vec_id),
yt AS (SELECT vec_id, o, CASE WHEN label = o THEN 1.0 ELSE 0.0 END AS y FROM embeddings, range(10) t(o)),
py AS (SELECT pred.vec_id, pred.o, pred.p, yt.y FROM pred JOIN yt ON pred.vec_id = yt.vec_id AND pred.o = yt.o)"""

SCORE_MLP_SQL = f"WITH {MLP_SQL} SELECT vec_id, CAST(o AS BIGINT) AS j, {R('p')} AS v FROM pred"


@query("dense_forward", f"""
WITH {X_SQL},
w AS (SELECT i AS k, j, ((i * 7 + j * 3) % 11 - 5) / 50.0 AS w FROM range(64) t(i), range(10) s(j)),
b AS (SELECT j, ((j % 3) - 1) / 10.0 AS b FROM range(10) s(j)),
z AS (SELECT x.vec_id, w.j, sum(x.v * w.w) + max(b.b) AS z FROM x JOIN w ON x.k = w.k JOIN b ON w.j = b.j
      GROUP BY x.vec_id, w.j)
SELECT vec_id, CAST(j AS BIGINT) AS j, {R('1 / (1 + exp(-z))')} AS v FROM z
""")
def q_dense_forward(spark, sf):
    """Dense layer as JVM expressions: row x W (inlined), + b, sigmoid."""
    w = np.array([[((i * 7 + j * 3) % 11 - 5) / 50.0 for j in range(10)] for i in range(64)])
    b = [((j % 3) - 1) / 10.0 for j in range(10)]
    rows = emb_rows(spark, sf).select("row_id", "x")
    z = la.rows_add_bias(la.rows_matmul_small(rows, w, 64), b)
    return cells(z.select("row_id", act.activate_array(F.col("x"), "sigmoid").alias("y_pred")))


# 1 x 8 x 8 images for the windowed layers
IMG_SQL = """img AS (SELECT vec_id, CAST(unnest(range(0, 64)) AS BIGINT) AS p, unnest(CAST(embedding AS DOUBLE[])) AS v
                FROM embeddings),
px AS (SELECT vec_id, p // 8 AS r, p % 8 AS c, v FROM img)"""


def window_cells(df, shape):
    c, h, w = shape
    out = df.select(F.col("row_id").alias("vec_id"), F.posexplode("y_pred").alias("idx", "v"))
    d, i, j = la.unflatten_index(F.col("idx"), h, w)
    return out.select("vec_id", d.cast("long").alias("d"), i.cast("long").alias("i"),
                      j.cast("long").alias("j"), r4("v").alias("v"))


@query("conv2d", f"""
WITH {IMG_SQL},
k AS (SELECT o, ki, kj, ((o * 5 + ki * 3 + kj * 2) % 7 - 3) / 10.0 AS w FROM range(2) a(o), range(3) b(ki), range(3) c(kj)),
outp AS (SELECT vec_id, o, oi, oj FROM (SELECT DISTINCT vec_id FROM img), range(2) a(o), range(4) b(oi), range(4) c(oj)),
z AS (SELECT outp.vec_id, outp.o, outp.oi, outp.oj, COALESCE(sum(k.w * px.v), 0) + (outp.o - 0.5) / 10.0 AS z
      FROM outp JOIN k ON k.o = outp.o
      LEFT JOIN px ON px.vec_id = outp.vec_id AND px.r = outp.oi * 2 - 1 + k.ki AND px.c = outp.oj * 2 - 1 + k.kj
      GROUP BY outp.vec_id, outp.o, outp.oi, outp.oj)
SELECT vec_id, CAST(o AS BIGINT) AS d, CAST(oi AS BIGINT) AS i, CAST(oj AS BIGINT) AS j,
       {R('greatest(z, 0)')} AS v FROM z
""")
def q_conv2d(spark, sf):
    m = Sequential((1, 8, 8), [Conv2D(2, (3, 3), (2, 2), (1, 1), "relu")], seed=0,
                   params=[{"w": kconv(), "b": bconv()}])
    return window_cells(predict(emb_rows(spark, sf), m), m.output_shape)


def kconv2():
    return np.array([[[[((o * 5 + c * 3 + i * 2 + j) % 7 - 3) / 10.0 for j in range(2)] for i in range(2)]
                      for c in range(2)] for o in range(3)])


@query("conv2d_multichannel", f"""
WITH img AS (SELECT vec_id, CAST(unnest(range(0, 64)) AS BIGINT) AS p, unnest(CAST(embedding AS DOUBLE[])) AS v
             FROM embeddings),
px AS (SELECT vec_id, p // 32 AS ch, (p % 32) // 8 AS r, p % 8 AS c, v FROM img),
k AS (SELECT o, ch, ki, kj, ((o * 5 + ch * 3 + ki * 2 + kj) % 7 - 3) / 10.0 AS w
      FROM range(3) a(o), range(2) b(ch), range(2) c(ki), range(2) d(kj)),
outp AS (SELECT vec_id, o, oi, oj FROM (SELECT DISTINCT vec_id FROM img), range(3) a(o), range(3) b(oi), range(5) c(oj)),
z AS (SELECT outp.vec_id, outp.o, outp.oi, outp.oj, COALESCE(sum(k.w * px.v), 0) + (outp.o - 1) / 10.0 AS z
      FROM outp JOIN k ON k.o = outp.o
      LEFT JOIN px ON px.vec_id = outp.vec_id AND px.ch = k.ch AND px.r = outp.oi + k.ki
                  AND px.c = outp.oj * 2 - 1 + k.kj
      GROUP BY outp.vec_id, outp.o, outp.oi, outp.oj)
SELECT vec_id, CAST(o AS BIGINT) AS d, CAST(oi AS BIGINT) AS i, CAST(oj AS BIGINT) AS j, {R('tanh(z)')} AS v FROM z
""")
def q_conv2d_multichannel(spark, sf):
    """2 input channels summed, asymmetric stride (1, 2) and padding (0, 1)."""
    m = Sequential((2, 4, 8), [Conv2D(3, (2, 2), (1, 2), (0, 1), "tanh")], seed=0,
                   params=[{"w": kconv2(), "b": np.array([(o - 1) / 10.0 for o in range(3)])}])
    return window_cells(predict(emb_rows(spark, sf), m), m.output_shape)


def _pool_sql(agg: str) -> str:
    return f"""
WITH {IMG_SQL},
outp AS (SELECT vec_id, oi, oj FROM (SELECT DISTINCT vec_id FROM img), range(5) b(oi), range(5) c(oj)),
z AS (SELECT outp.vec_id, outp.oi, outp.oj, {agg} AS z
      FROM outp JOIN px ON px.vec_id = outp.vec_id
           AND px.r BETWEEN outp.oi * 2 - 1 AND outp.oi * 2 AND px.c BETWEEN outp.oj * 2 - 1 AND outp.oj * 2
      GROUP BY outp.vec_id, outp.oi, outp.oj)
SELECT vec_id, CAST(0 AS BIGINT) AS d, CAST(oi AS BIGINT) AS i, CAST(oj AS BIGINT) AS j, {R('z')} AS v FROM z"""


@query("max_pool2d", _pool_sql("max(px.v)"))
def q_max_pool2d(spark, sf):
    m = Sequential((1, 8, 8), [MaxPool2D((2, 2), (2, 2), (1, 1))], seed=0)
    return window_cells(predict(emb_rows(spark, sf), m), m.output_shape)


@query("avg_pool2d", _pool_sql("sum(px.v) / 4.0"))
def q_avg_pool2d(spark, sf):
    m = Sequential((1, 8, 8), [AvgPool2D((2, 2), (2, 2), (1, 1))], seed=0)
    return window_cells(predict(emb_rows(spark, sf), m), m.output_shape)


@query("dropout_mask", f"""
WITH {X_SQL},
u AS (SELECT k, row_number() OVER (ORDER BY md5('11:1:0:0:' || CAST(k AS VARCHAR)), k) - 1 AS rk FROM range(64) t(k))
SELECT vec_id, CAST(x.k AS BIGINT) AS p, {R('CASE WHEN u.rk < 16 THEN 0.0 ELSE x.v / 0.75 END')} AS v
FROM x JOIN u ON x.k = u.k
""")
def q_dropout_mask(spark, sf):
    mask = dropout_mask(64, 0.25, seed=11, step=1, layer=0, k=0)   # model-sized (64 units)
    rows = emb_rows(spark, sf).select("row_id", "x")
    out = rows.select("row_id", F.zip_with("x", double_array_lit(mask), lambda a, b: a * b).alias("y_pred"))
    return cells(out).withColumnRenamed("j", "p")


@query("score_mlp", SCORE_MLP_SQL)
def q_score_mlp(spark, sf):
    return cells(predict(emb_rows(spark, sf), mlp()))


def cnn() -> Sequential:
    return Sequential((1, 8, 8), [Conv2D(4, (3, 3), (1, 1), (1, 1), "relu"), MaxPool2D((2, 2), (2, 2)),
                                  Flatten(), Dense(10, "softmax")], seed=5)


def _u_sql(tag: str, idx: str) -> str:
    """SQL form of the md5-seeded uniform(-0.1, 0.1) parameter initialiser."""
    return (f"(CAST(CAST('0x' || substr(md5('5:{tag}:' || CAST({idx} AS VARCHAR)), 1, 8) AS BIGINT) AS DOUBLE)"
            f" / 4294967296.0 * 0.2 - 0.1)")


# the conv net's forward pass as CTEs: conv (pre-activation zc, relu a),
# 2x2 max pool flattened to f = channel*16 + row*4 + col, dense, softmax
CNN_FWD_SQL = f"""{IMG_SQL},
k AS (SELECT o, ki, kj, {_u_sql('0:w', 'o * 9 + ki * 3 + kj')} AS w FROM range(4) a(o), range(3) b(ki), range(3) c(kj)),
kb AS (SELECT o, {_u_sql('0:b', 'o')} AS b FROM range(4) a(o)),
outp AS (SELECT vec_id, o, oi, oj FROM (SELECT DISTINCT vec_id FROM img), range(4) a(o), range(8) b(oi), range(8) c(oj)),
conv AS (SELECT outp.vec_id, outp.o, outp.oi, outp.oj, COALESCE(sum(k.w * px.v), 0) + max(kb.b) AS zc
         FROM outp JOIN k ON k.o = outp.o JOIN kb ON kb.o = outp.o
         LEFT JOIN px ON px.vec_id = outp.vec_id AND px.r = outp.oi - 1 + k.ki AND px.c = outp.oj - 1 + k.kj
         GROUP BY outp.vec_id, outp.o, outp.oi, outp.oj),
ca AS (SELECT vec_id, o, oi, oj, zc, greatest(zc, 0) AS a FROM conv),
pool AS (SELECT vec_id, o * 16 + (oi // 2) * 4 + (oj // 2) AS f, max(a) AS m
         FROM ca GROUP BY vec_id, o, oi // 2, oj // 2),
dw AS (SELECT f, j, {_u_sql('3:w', 'f * 10 + j')} AS w FROM range(64) a(f), range(10) b(j)),
db AS (SELECT j, {_u_sql('3:b', 'j')} AS b FROM range(10) b(j)),
z AS (SELECT pool.vec_id, dw.j, sum(pool.m * dw.w) + max(db.b) AS z
      FROM pool JOIN dw ON pool.f = dw.f JOIN db ON db.j = dw.j GROUP BY pool.vec_id, dw.j),
zm AS (SELECT vec_id, max(z) AS mx FROM z GROUP BY vec_id),
ez AS (SELECT z.vec_id, z.j, exp(z.z - zm.mx) AS e FROM z JOIN zm ON z.vec_id = zm.vec_id),
es AS (SELECT vec_id, sum(e) AS s FROM ez GROUP BY vec_id)"""

SCORE_CNN_SQL = f"""WITH {CNN_FWD_SQL}
SELECT ez.vec_id, CAST(ez.j AS BIGINT) AS j, {R('ez.e / es.s')} AS v FROM ez JOIN es ON ez.vec_id = es.vec_id
"""

# mean gradient over all rows (cce): delta = p - y at the softmax; max-pool
# gradient to the first arg-max of each window; relu derivative zc > 0
CNN_GRAD_SQL = f"""WITH {CNN_FWD_SQL},
n AS (SELECT count(*) AS n FROM embeddings),
p AS (SELECT ez.vec_id, ez.j, ez.e / es.s - CASE WHEN em.label = ez.j THEN 1.0 ELSE 0.0 END AS d
      FROM ez JOIN es ON ez.vec_id = es.vec_id JOIN embeddings em ON em.vec_id = ez.vec_id),
gd AS (SELECT pool.f, p.j, sum(pool.m * p.d) / (SELECT n FROM n) AS g FROM pool JOIN p ON pool.vec_id = p.vec_id
       GROUP BY pool.f, p.j),
gdb AS (SELECT j, sum(d) / (SELECT n FROM n) AS g FROM p GROUP BY j),
dpool AS (SELECT p.vec_id, dw.f, sum(p.d * dw.w) AS d FROM p JOIN dw ON p.j = dw.j GROUP BY p.vec_id, dw.f),
win AS (SELECT vec_id, o, oi, oj, zc, a, o * 16 + (oi // 2) * 4 + (oj // 2) AS f,
               (oi % 2) * 2 + (oj % 2) AS pos FROM ca),
arg AS (SELECT vec_id, f, arg_min(pos, (-a, pos)) AS pos FROM win GROUP BY vec_id, f),
dz AS (SELECT win.vec_id, win.o, win.oi, win.oj, CASE WHEN win.zc > 0 THEN dpool.d ELSE 0.0 END AS d
       FROM win JOIN arg ON win.vec_id = arg.vec_id AND win.f = arg.f AND win.pos = arg.pos
       JOIN dpool ON dpool.vec_id = win.vec_id AND dpool.f = win.f),
gk AS (SELECT k.o, k.ki, k.kj, sum(dz.d * px.v) / (SELECT n FROM n) AS g
       FROM dz JOIN k ON k.o = dz.o
       JOIN px ON px.vec_id = dz.vec_id AND px.r = dz.oi - 1 + k.ki AND px.c = dz.oj - 1 + k.kj
       GROUP BY k.o, k.ki, k.kj),
gk_all AS (SELECT k.o, k.ki, k.kj, COALESCE(gk.g, 0.0) AS g FROM k
           LEFT JOIN gk ON gk.o = k.o AND gk.ki = k.ki AND gk.kj = k.kj),
gkb AS (SELECT o, sum(d) / (SELECT n FROM n) AS g FROM dz GROUP BY o),
allg AS (SELECT 0 AS layer, 'w' AS param, o * 9 + ki * 3 + kj AS idx, g FROM gk_all
         UNION ALL SELECT 0, 'b', o, g FROM gkb
         UNION ALL SELECT 3, 'w', f * 10 + j, g FROM gd
         UNION ALL SELECT 3, 'b', j, g FROM gdb)
SELECT CAST(layer AS BIGINT) AS layer, param, CAST(idx AS BIGINT) AS idx, {R6('g')} AS g FROM allg
"""


@query("evaluate_conv_tensor", f"""
WITH {IMG_SQL},
k AS (SELECT o, ki, kj, ((o * 5 + ki * 3 + kj * 2) % 7 - 3) / 10.0 AS w FROM range(2) a(o), range(3) b(ki), range(3) c(kj)),
outp AS (SELECT vec_id, o, oi, oj FROM (SELECT DISTINCT vec_id FROM img), range(2) a(o), range(8) b(oi), range(8) c(oj)),
z AS (SELECT outp.vec_id, outp.o, outp.oi, outp.oj, COALESCE(sum(k.w * px.v), 0) + (outp.o - 0.5) / 10.0 AS z
      FROM outp JOIN k ON k.o = outp.o
      LEFT JOIN px ON px.vec_id = outp.vec_id AND px.r = outp.oi - 1 + k.ki AND px.c = outp.oj - 1 + k.kj
      GROUP BY outp.vec_id, outp.o, outp.oi, outp.oj),
pz AS (SELECT least(greatest(1 / (1 + exp(-z.z)), 1e-8), 1 - 1e-8) AS q, 1 / (1 + exp(-z.z)) AS p,
              CASE WHEN px.v > 0 THEN 1.0 ELSE 0.0 END AS y
       FROM z JOIN px ON px.vec_id = z.vec_id AND px.r = z.oi AND px.c = z.oj)
SELECT {R('avg(-(y * ln(q) + (1 - y) * ln(1 - q)))')} AS loss,
       {R('avg(CASE WHEN (CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END) = y THEN 1.0 ELSE 0.0 END)')} AS metric
FROM pz
""")
def q_evaluate_conv_tensor(spark, sf):
    """Tensor output (2 x 8 x 8, sigmoid): binary cross-entropy and binary
    accuracy over every element; target = pixel > 0, for both channels."""
    m = Sequential((1, 8, 8), [Conv2D(2, (3, 3), (1, 1), (1, 1), "sigmoid")], seed=0,
                   params=[{"w": kconv(), "b": bconv()}])
    rows = emb_rows(spark, sf).select("row_id", "x")
    flag = F.transform("x", lambda v: (v > 0).cast("double"))
    data = rows.withColumn("_f", flag).select("row_id", "x", F.concat("_f", "_f").alias("y"))
    r = evaluate(m, Dataset(data, [str(i) for i in range(64)], (1, 8, 8), None),
                 "binary_crossentropy", "binary_accuracy")
    return r.select(r4("loss").alias("loss"), r4("metric").alias("metric"))


@query("score_cnn", SCORE_CNN_SQL)
def q_score_cnn(spark, sf):
    return cells(predict(emb_rows(spark, sf), cnn()))


@query("model_roundtrip", SCORE_MLP_SQL)
def q_model_roundtrip(spark, sf):
    path = scratch_path(spark, "model")
    save_model(spark, mlp(), path)
    return cells(predict(emb_rows(spark, sf), load_model(spark, path)))


def _metric_query(name: str, spark_expr, sql_expr: str):
    @query(name, f"WITH {MLP_SQL} SELECT {R(sql_expr)} AS value")
    def run(spark, sf):
        pred = predict(emb_rows(spark, sf), mlp(), keep=["y"])
        return pred.agg(spark_expr(F.col("y_pred"), F.col("y")).alias("value")).select(r4("value").alias("value"))
    return run


_metric_query("loss_mse", M.mse, "(SELECT sum((p - y) * (p - y)) / count(*) FROM py)")
_metric_query("metric_mae", M.mae, "(SELECT sum(abs(p - y)) / count(*) FROM py)")
_metric_query("loss_bce", M.binary_crossentropy,
              "(SELECT avg(-(y * ln(least(greatest(p, 1e-8), 1 - 1e-8)) + (1 - y) * ln(1 - least(greatest(p, 1e-8), 1 - 1e-8)))) FROM py WHERE o = 0)")
_metric_query("loss_cce", M.categorical_crossentropy,
              "(SELECT sum(CASE WHEN y = 1 THEN -ln(p + 1e-10) ELSE 0 END) / count(DISTINCT vec_id) FROM py)")
_metric_query("metric_binary_accuracy", M.binary_accuracy,
              "(SELECT avg(CASE WHEN (CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END) = y THEN 1.0 ELSE 0.0 END) FROM py WHERE o = 0)")
ARGMAX_SQL = """(SELECT avg(y) FROM (SELECT vec_id, arg_min(y, (-p, o)) AS y FROM py GROUP BY vec_id))"""
_metric_query("metric_categorical_accuracy", M.categorical_accuracy, ARGMAX_SQL)
_metric_query("metric_accuracy", lambda p, y: M.metric_expr("accuracy", p, y, 10), ARGMAX_SQL)


@query("evaluate_mlp", f"""
WITH {MLP_SQL}
SELECT {R("(SELECT sum(CASE WHEN y = 1 THEN -ln(p + 1e-10) ELSE 0 END) / count(DISTINCT vec_id) FROM py)")} AS loss,
       {R(ARGMAX_SQL)} AS metric
""")
def q_evaluate_mlp(spark, sf):
    r = evaluate(mlp(), emb_dataset(spark, sf), "categorical_crossentropy", "accuracy")
    return r.select(r4("loss").alias("loss"), r4("metric").alias("metric"))
