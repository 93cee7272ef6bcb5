"""Matrix / tensor algebra.

A (orders, one row per order): [o_totalprice / 997, o_custkey / 97]
B (one row per order, 0 without line items): [sum(l_quantity) / 7, sum(l_extendedprice) / 9973]
(divisors chosen so that no value sits on a 4-decimal rounding tie)
W: closed-form 2 x 3 parameters w[i, j] = ((7i + 3j) % 11 - 5) / 50.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tessera.functions.numeric import r4
from tessera.operators import linalg as la
from tessera.operators import tiles
from tessera.registry.base import R, query, tbl

A_SQL = """a AS (SELECT o_orderkey AS i, 0 AS j, o_totalprice / 997 AS v FROM orders
          UNION ALL SELECT o_orderkey, 1, o_custkey / 97.0 FROM orders)"""
B_SQL = """l AS (SELECT o_orderkey AS i, coalesce(sum(l_quantity), 0.0) AS q, coalesce(sum(l_extendedprice), 0.0) AS p
            FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey),
          b AS (SELECT i, 0 AS j, q / 7 AS v FROM l UNION ALL SELECT i, 1, p / 9973 FROM l)"""


def a_rows(spark, sf):
    o = tbl(spark, sf, "orders", ["o_orderkey", "o_totalprice", "o_custkey"])
    return o.select(F.col("o_orderkey").alias("i"),
                    F.array(F.col("o_totalprice") / 997, F.col("o_custkey") / 97.0).alias("x"))


def b_rows(spark, sf):
    li = tbl(spark, sf, "lineitem", ["l_orderkey", "l_quantity", "l_extendedprice"])
    per = li.groupBy(F.col("l_orderkey").alias("i")).agg(F.sum("l_quantity").alias("q"), F.sum("l_extendedprice").alias("p"))
    orders = tbl(spark, sf, "orders", ["o_orderkey"]).select(F.col("o_orderkey").alias("i"))
    return orders.join(per, "i", "left").select(
        "i", F.array(F.coalesce("q", F.lit(0.0)) / 7, F.coalesce("p", F.lit(0.0)) / 9973).alias("x"))


def w_small() -> np.ndarray:
    return np.array([[((i * 7 + j * 3) % 11 - 5) / 50.0 for j in range(3)] for i in range(2)])


def cells_out(df):
    return df.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), r4("v").alias("v"))


@query("matrix_fill", """
SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, CAST(0.5 AS DOUBLE) AS v
FROM (SELECT row_number() OVER () - 1 AS i FROM lineitem) r, range(4) t(j)
""")
def q_matrix_fill(spark, sf):
    n = tbl(spark, sf, "lineitem", ["l_orderkey"]).count()
    return cells_out(la.fill_cells(spark, n, 4, 0.5))


@query("matrix_fill_keys", """
SELECT o_orderkey AS i, CAST(j AS BIGINT) AS j, CAST(0.25 AS DOUBLE) AS v FROM orders, range(3) t(j)
""")
def q_matrix_fill_keys(spark, sf):
    """A filled matrix with a row for each key of a table."""
    return cells_out(la.fill_like(tbl(spark, sf, "orders", ["o_orderkey"]), "o_orderkey", 3, 0.25))


def _ew(name, op, sym):
    sql = f"""
WITH {A_SQL}, {B_SQL}
SELECT CAST(a.i AS BIGINT) AS i, CAST(a.j AS BIGINT) AS j, {R(f'a.v {sym} b.v')} AS v
FROM a FULL JOIN b ON a.i = b.i AND a.j = b.j"""

    @query(name, sql)
    def run(spark, sf):
        out = la.rows_elementwise(a_rows(spark, sf), b_rows(spark, sf), ["i"], op, 2, 2)
        return cells_out(la.rows_to_cells(out, "i"))
    return run


_ew("matrix_add", "add", "+")
_ew("matrix_subtract", "sub", "-")
_ew("matrix_hadamard", "mul", "*")


@query("matrix_scale", f"WITH {A_SQL} SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, {R('v * 2.5')} AS v FROM a")
def q_matrix_scale(spark, sf):
    return cells_out(la.rows_to_cells(la.rows_scale(a_rows(spark, sf), 2.5), "i"))


W_SQL = "w AS (SELECT i, j, ((i * 7 + j * 3) % 11 - 5) / 50.0 AS v FROM range(2) t(i), range(3) s(j))"


@query("matrix_multiply", f"""
WITH {A_SQL}, {W_SQL}
SELECT CAST(a.i AS BIGINT) AS i, CAST(w.j AS BIGINT) AS j, {R('sum(a.v * w.v)')} AS v
FROM a JOIN w ON a.j = w.i GROUP BY a.i, w.j
""")
def q_matrix_multiply(spark, sf):
    a = la.rows_to_cells(a_rows(spark, sf), "i")
    w = w_small()
    wc = spark.createDataFrame([(i, j, float(w[i, j])) for i in range(2) for j in range(3)],
                               "i long, j long, v double")
    return cells_out(la.cells_matmul(a, wc, w.size))


@query("matrix_multiply_rows", f"""
WITH {A_SQL}, {W_SQL}
SELECT CAST(a.i AS BIGINT) AS i, CAST(w.j AS BIGINT) AS j, {R('sum(a.v * w.v)')} AS v
FROM a JOIN w ON a.j = w.i GROUP BY a.i, w.j
""")
def q_matrix_multiply_rows(spark, sf):
    out = la.rows_matmul_small(a_rows(spark, sf), w_small(), 2)
    return cells_out(la.rows_to_cells(out, "i"))


@query("gram_matrix", f"""
SELECT 0::BIGINT AS i, 0::BIGINT AS j, {R('sum(l_quantity * l_discount)')} AS v FROM lineitem
UNION ALL SELECT 0, 1, {R('sum(l_quantity * l_tax)')} FROM lineitem
UNION ALL SELECT 1, 0, {R('sum(l_extendedprice / 1000 * l_discount)')} FROM lineitem
UNION ALL SELECT 1, 1, {R('sum(l_extendedprice / 1000 * l_tax)')} FROM lineitem
""")
def q_gram_matrix(spark, sf):
    li = tbl(spark, sf, "lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    rows = li.select(F.array("l_quantity", F.col("l_extendedprice") / 1000).alias("x"),
                     F.array("l_discount", "l_tax").alias("y"))
    return cells_out(la.gram_cells(rows, 2, 2))


@query("matrix_transpose", f"WITH {A_SQL} SELECT CAST(j AS BIGINT) AS i, CAST(i AS BIGINT) AS j, {R('v')} AS v FROM a")
def q_matrix_transpose(spark, sf):
    return cells_out(la.cells_transpose(la.rows_to_cells(a_rows(spark, sf), "i")))


@query("bias_add", f"""
WITH {A_SQL}
SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, {R('v + CASE WHEN j = 0 THEN 0.5 ELSE -0.25 END')} AS v FROM a
""")
def q_bias_add(spark, sf):
    return cells_out(la.rows_to_cells(la.rows_add_bias(a_rows(spark, sf), [0.5, -0.25]), "i"))


EMB_SQL = """e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
long AS (SELECT vec_id, unnest(range(0, len(x))) AS p, unnest(x) AS v FROM e)"""


def emb(spark, sf):
    return tbl(spark, sf, "embeddings", ["vec_id", "embedding"]) \
        .select("vec_id", F.col("embedding").cast("array<double>").alias("x"))


def tensor_out(df):
    return df.select("vec_id", F.col("d").cast("long").alias("d"), F.col("i").cast("long").alias("i"),
                     F.col("j").cast("long").alias("j"), r4("v").alias("v"))


@query("matrix_rot180", f"""
WITH {EMB_SQL}
SELECT vec_id, CAST(p // 64 AS BIGINT) AS d, CAST((p % 64) // 8 AS BIGINT) AS i, CAST(p % 8 AS BIGINT) AS j,
       {R('x[64 - p]')} AS v
FROM (SELECT vec_id, x, unnest(range(0, 64)) AS p FROM e)
""")
def q_matrix_rot180(spark, sf):
    shape = (1, 8, 8)
    e = emb(spark, sf).withColumn("x", la.rot180_array(F.col("x"), shape))
    return tensor_out(la.tensor_cells(e, "vec_id", "x", shape))


@query("tensor_flatten", f"""
WITH {EMB_SQL}
SELECT vec_id, CAST(p AS BIGINT) AS idx, CAST(p // 32 AS BIGINT) AS d, CAST((p % 32) // 8 AS BIGINT) AS i,
       CAST(p % 8 AS BIGINT) AS j, {R('v')} AS v
FROM long
""")
def q_tensor_flatten(spark, sf):
    cells = la.tensor_cells(emb(spark, sf), "vec_id", "x", (2, 4, 8))
    flat = cells.withColumn("idx", la.flat_index(F.col("d"), F.col("i"), F.col("j"), 4, 8).cast("long"))
    d, i, j = la.unflatten_index(F.col("idx"), 4, 8)
    back = flat.select("vec_id", "idx", d.alias("d"), i.alias("i"), j.alias("j"), "v")
    return back.select("vec_id", "idx", F.col("d").cast("long").alias("d"), F.col("i").cast("long").alias("i"),
                       F.col("j").cast("long").alias("j"), r4("v").alias("v"))


@query("init_params", f"""
WITH dims AS (SELECT max(len(embedding)) AS r, count(DISTINCT label) AS c FROM embeddings),
ids AS (SELECT unnest(range(0, (SELECT r * c + c FROM dims))) AS id)
SELECT CAST(0 AS BIGINT) AS layer, CASE WHEN id < (SELECT r * c FROM dims) THEN 'w' ELSE 'b' END AS param,
       CAST(CASE WHEN id < (SELECT r * c FROM dims) THEN id ELSE id - (SELECT r * c FROM dims) END AS BIGINT) AS idx,
       {R("CAST(CAST('0x' || substr(md5('7:0:' || CAST(id AS VARCHAR)), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 * 0.2 - 0.1")} AS v
FROM ids
""")
def q_init_params(spark, sf):
    e = tbl(spark, sf, "embeddings", ["embedding", "label"])
    r = e.agg(F.max(F.size("embedding")).alias("r"), F.countDistinct("label").alias("c")).collect()[0]
    p = la.init_params(spark, 0, int(r["r"]), int(r["c"]), seed=7)
    return p.select(F.col("layer").cast("long").alias("layer"), "param", F.col("idx").cast("long").alias("idx"),
                    r4("v").alias("v"))


@query("matrix_multiply_tiles", """
WITH a AS (SELECT l_suppkey AS i, l_partkey AS k, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
b AS (SELECT l_partkey AS k, l_suppkey AS j, count(*) AS v FROM lineitem GROUP BY 1, 2)
SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, CAST(sum(a.v * b.v) AS DOUBLE) AS v
FROM a JOIN b USING (k) GROUP BY 1, 2
""")
def q_matrix_multiply_tiles(spark, sf):
    """Quantities by supplier and part times lines by part and supplier: two
    matrices that both grow with the data, in dense tiles."""
    li = tbl(spark, sf, "lineitem", ["l_suppkey", "l_partkey", "l_quantity"])
    m, k = (1 + (top or 0) for top in li.agg(F.max("l_suppkey"), F.max("l_partkey")).first())
    s, p = F.col("l_suppkey").cast("long"), F.col("l_partkey").cast("long")
    both = li.groupBy(s.alias("i"), p.alias("j")).agg(F.sum("l_quantity").cast("double").alias("v"),
                                                      F.count(F.lit(1)).cast("double").alias("w"))
    wide = tiles.groups_wide(li.select(p.alias("inner"), s.alias("outer")), k, m)
    out = tiles.cells_matmul_large(both, None, (m, k), (k, m), zeros=False, wide=wide)
    return out.where("v != 0")              # no cell of either matrix is below 0: pairs with a part in common


@query("gram_matrix_tiles", f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
long AS (SELECT vec_id, unnest(range(0, len(x))) AS p, unnest(x) AS v FROM e)
SELECT a.p AS i, b.p AS j, {R('sum(a.v * b.v)')} AS v FROM long a JOIN long b USING (vec_id) GROUP BY 1, 2
""")
def q_gram_matrix_tiles(spark, sf):
    """All products of two columns of the vectors, in tiles narrower than the vectors."""
    e = tbl(spark, sf, "embeddings", ["embedding"]).withColumnRenamed("embedding", "x")
    width = e.agg(F.max(F.size("x"))).first()[0] or 0
    return cells_out(tiles.gram_tiles(e, width, width, "x", "x", size=16))
