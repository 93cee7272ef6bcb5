"""Activation functions (F1-F8) on embedding values z = 10 * x."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import activations as act
from tessera.functions.numeric import r4
from tessera.registry.base import R, query, tbl

LONG_SQL = """e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
long AS (SELECT vec_id, unnest(range(0, len(x))) AS p, 10 * unnest(x) AS z FROM e)"""


def z_long(spark, sf):
    e = tbl(spark, sf, "embeddings", ["vec_id", "embedding"])
    return e.select("vec_id", F.posexplode(F.col("embedding").cast("array<double>")).alias("p", "x")) \
        .select("vec_id", F.col("p").cast("long").alias("p"), (F.col("x") * 10).alias("z"))


SIG = "1 / (1 + exp(-z))"
SOFTPLUS = "(greatest(z, 0) + ln(1 + exp(-abs(z))))"


@query("activations", f"""
WITH {LONG_SQL}
SELECT vec_id, CAST(p AS BIGINT) AS p, {R('z')} AS linear, {R('CASE WHEN z > 0 THEN z ELSE 0 END')} AS relu,
       {R(SIG)} AS sigmoid, {R('tanh(z)')} AS tanh, {R(SOFTPLUS)} AS softplus
FROM long
""")
def q_activations(spark, sf):
    z = F.col("z")
    names = ("linear", "relu", "sigmoid", "tanh", "softplus")
    vals = z_long(spark, sf).select("vec_id", "p", *[act.activate(z, n).alias(n) for n in names])
    return vals.select("vec_id", "p", *[r4(n).alias(n) for n in names])


@query("activation_derivatives", f"""
WITH {LONG_SQL}
SELECT vec_id, CAST(p AS BIGINT) AS p, CAST(1.0 AS DOUBLE) AS d_linear,
       CAST(CASE WHEN z > 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS d_relu,
       {R(f'({SIG}) * (1 - {SIG})')} AS d_sigmoid, {R('1 - tanh(z) * tanh(z)')} AS d_tanh,
       {R(SIG)} AS d_softplus
FROM long
""")
def q_activation_derivatives(spark, sf):
    z = F.col("z")
    names = [f"d_{n}" for n in ("linear", "relu", "sigmoid", "tanh", "softplus")]
    out = [act.derivative(act.activate(z, n), z, n).alias(f"d_{n}")
           for n in ("linear", "relu", "sigmoid", "tanh", "softplus")]
    vals = z_long(spark, sf).select("vec_id", "p", *out)
    return vals.select("vec_id", "p", *[r4(n).alias(n) for n in names])


def _softmax_sql(group: str) -> str:
    return f"""
WITH {LONG_SQL},
m AS (SELECT vec_id, {group} AS g, max(z) AS mx FROM long GROUP BY vec_id, {group}),
ex AS (SELECT l.vec_id, l.p, exp(l.z - m.mx) AS ez, m.g FROM long l JOIN m ON l.vec_id = m.vec_id AND {group.replace('p', 'l.p')} = m.g),
s AS (SELECT vec_id, g, sum(ez) AS s FROM ex GROUP BY vec_id, g)
SELECT ex.vec_id, CAST(ex.p AS BIGINT) AS p, {R('ez / s')} AS v FROM ex JOIN s ON ex.vec_id = s.vec_id AND ex.g = s.g"""


def _arr(spark, sf):
    e = tbl(spark, sf, "embeddings", ["vec_id", "embedding"])
    return e.select("vec_id", F.transform(F.col("embedding").cast("array<double>"), lambda v: v * 10).alias("z"))


def _explode(df):
    return df.select("vec_id", F.posexplode("a").alias("p", "v")) \
        .select("vec_id", F.col("p").cast("long").alias("p"), r4("v").alias("v"))


@query("softmax_rows", _softmax_sql("(p // 1000)"))
def q_softmax_rows(spark, sf):
    return _explode(_arr(spark, sf).select("vec_id", act.activate_array(F.col("z"), "softmax").alias("a")))


@query("softmax_tensor_rows", _softmax_sql("(p // 8)"))
def q_softmax_tensor_rows(spark, sf):
    return _explode(_arr(spark, sf).select("vec_id", act.softmax_tensor_rows(F.col("z"), 1, 8, 8).alias("a")))
