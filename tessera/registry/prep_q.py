"""Table preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.numeric import r4
from tessera.operators import dataset as ds
from tessera.operators import encode, sparse, split
from tessera.operators.impute import fit_imputer
from tessera.operators.scale import fit_scaler, fit_scaler_array
from tessera.registry.base import R, query, tbl

# events with missing values injected on both sides (no shared table has NULLs)
EV_SQL = """ev AS (
  SELECT event_id,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type
  FROM events)"""


def events_with_missing(spark, sf):
    e = tbl(spark, sf, "events", ["event_id", "event_type", "value"])
    return e.select("event_id",
                    F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("value")).alias("value"),
                    F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("event_type"))
                    .alias("event_type"))


@query("impute_mean", f"""
WITH {EV_SQL}, f AS (SELECT avg(value) AS m FROM ev)
SELECT event_id, {R('COALESCE(value, m)')} AS value FROM ev, f
""")
def q_impute_mean(spark, sf):
    ev = events_with_missing(spark, sf)
    imp = fit_imputer(ev, ["value"], "mean")
    return imp.transform(ev).select("event_id", r4("value").alias("value"))


@query("impute_median", f"""
WITH {EV_SQL}, f AS (SELECT median(value) AS m FROM ev)
SELECT event_id, {R('COALESCE(value, m)')} AS value FROM ev, f
""")
def q_impute_median(spark, sf):
    ev = events_with_missing(spark, sf)
    imp = fit_imputer(ev, ["value"], "median")
    return imp.transform(ev).select("event_id", r4("value").alias("value"))


@query("impute_constant", f"""
WITH {EV_SQL}
SELECT event_id, {R('COALESCE(value, -1.0)')} AS value, COALESCE(event_type, 'unknown') AS event_type FROM ev
""")
def q_impute_constant(spark, sf):
    ev = events_with_missing(spark, sf)
    imp = fit_imputer(ev, ["value"], "constant", -1.0, ["event_type"], "constant", "unknown")
    return imp.transform(ev).select("event_id", r4("value").alias("value"), "event_type")


@query("impute_mode", f"""
WITH {EV_SQL},
m AS (SELECT event_type AS v FROM ev WHERE event_type IS NOT NULL
      GROUP BY event_type ORDER BY count(*) DESC, event_type ASC LIMIT 1)
SELECT event_id, COALESCE(event_type, v) AS event_type FROM ev, m
""")
def q_impute_mode(spark, sf):
    ev = events_with_missing(spark, sf)
    imp = fit_imputer(ev, strings=["event_type"], string_strategy="most_frequent")
    return imp.transform(ev).select("event_id", "event_type")


LKEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LNUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _scale_sql(kind: str) -> str:
    if kind == "standard":
        stats = ", ".join(f"avg({c}) AS a_{c}, stddev_samp({c}) AS b_{c}" for c in LNUM)
        cols = ", ".join(f"{R(f'({c} - a_{c}) / NULLIF(b_{c}, 0)')} AS {c}" for c in LNUM)
    else:
        stats = ", ".join(f"min({c}) AS a_{c}, max({c}) AS b_{c}" for c in LNUM)
        cols = ", ".join(f"{R(f'({c} - a_{c}) / NULLIF(b_{c} - a_{c}, 0)')} AS {c}" for c in LNUM)
    return f"""
WITH st AS (SELECT {stats} FROM lineitem)
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       l_partkey, l_suppkey, {cols}
FROM lineitem, st"""


def _scale_q(kind):
    def run(spark, sf):
        li = tbl(spark, sf, "lineitem", LKEY + LNUM)
        sc = fit_scaler(li, LNUM, kind)
        out = sc.transform(li)
        return out.select(F.col("l_orderkey").cast("long").alias("l_orderkey"),
                          F.col("l_linenumber").cast("long").alias("l_linenumber"),
                          "l_partkey", "l_suppkey", *[r4(c).alias(c) for c in LNUM])
    return run


query("standard_scale", _scale_sql("standard"))(_scale_q("standard"))
query("minmax_scale", _scale_sql("minmax"))(_scale_q("minmax"))

EMB_LONG_SQL = """e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
long AS (SELECT vec_id, unnest(range(0, len(x))) AS pos, unnest(x) AS v FROM e)"""


def _scale_array_sql(kind: str) -> str:
    if kind == "standard":
        st, expr = "avg(v) AS a, stddev_samp(v) AS b", "(v - a) / NULLIF(b, 0)"
    else:
        st, expr = "min(v) AS a, max(v) AS b", "(v - a) / NULLIF(b - a, 0)"
    return f"""
WITH {EMB_LONG_SQL},
st AS (SELECT pos, {st} FROM long GROUP BY pos)
SELECT vec_id, CAST(pos AS BIGINT) AS pos, {R(expr)} AS v FROM long JOIN st USING (pos)"""


def _scale_array_q(kind):
    def run(spark, sf):
        emb = tbl(spark, sf, "embeddings", ["vec_id", "embedding"]).withColumnRenamed("embedding", "x")
        sc = fit_scaler_array(emb, "x", kind)
        out = sc.transform_array(emb, "x")
        return out.select("vec_id", F.posexplode("x").alias("pos", "v")) \
            .select("vec_id", F.col("pos").cast("long").alias("pos"), r4("v").alias("v"))
    return run


query("standard_scale_array", _scale_array_sql("standard"))(_scale_array_q("standard"))
query("minmax_scale_array", _scale_array_sql("minmax"))(_scale_array_q("minmax"))


def _dict_sql(table: str, value: str, key: str, where: str = "") -> str:
    return f"""(SELECT value, CAST(row_number() OVER (ORDER BY first) - 1 AS BIGINT) AS code
     FROM (SELECT COALESCE(CAST({value} AS VARCHAR), 'nan') AS value, min({key}) AS first
           FROM {table} {where} GROUP BY 1) t)"""


@query("label_dictionary", f"SELECT * FROM {_dict_sql('orders', 'o_orderpriority', 'o_orderkey')} d")
def q_label_dictionary(spark, sf):
    o = tbl(spark, sf, "orders", ["o_orderkey", "o_orderpriority"])
    d = encode.fit_dictionary(o, encode.category_key(F.col("o_orderpriority")), "o_orderkey")
    return d.df.select("value", F.col("code").cast("long").alias("code"))


@query("label_encode", f"""
WITH d AS {_dict_sql('orders', 'o_orderstatus', 'o_orderkey')}
SELECT o_orderkey, COALESCE(d.code, -1) AS code
FROM orders LEFT JOIN d ON COALESCE(CAST(o_orderstatus AS VARCHAR), 'nan') = d.value
""")
def q_label_encode(spark, sf):
    o = tbl(spark, sf, "orders", ["o_orderkey", "o_orderstatus"])
    key = encode.category_key(F.col("o_orderstatus"))
    d = encode.fit_dictionary(o, key, "o_orderkey")
    return encode.label_encode(o, key, d).select("o_orderkey", F.col("code").cast("long").alias("code"))


PART_DICT = _dict_sql("part", "p_type", "p_partkey", "WHERE p_type <> 'ECONOMY'")


def _part_codes(spark, sf):
    p = tbl(spark, sf, "part", ["p_partkey", "p_type"])
    key = encode.category_key(F.col("p_type"))
    d = encode.fit_dictionary(p.where(F.col("p_type") != "ECONOMY"), key, "p_partkey")
    return p, key, d


@query("label_encode_unseen", f"""
WITH d AS {PART_DICT}
SELECT p_partkey, COALESCE(d.code, -1) AS code
FROM part LEFT JOIN d ON COALESCE(CAST(p_type AS VARCHAR), 'nan') = d.value
""")
def q_label_encode_unseen(spark, sf):
    p, key, d = _part_codes(spark, sf)
    return encode.label_encode(p, key, d).select("p_partkey", F.col("code").cast("long").alias("code"))


@query("one_hot_encode", f"""
WITH d AS {PART_DICT},
pc AS (SELECT p_partkey, COALESCE(d.code, -1) AS code
       FROM part LEFT JOIN d ON COALESCE(CAST(p_type AS VARCHAR), 'nan') = d.value)
SELECT p_partkey, d.code AS j, CAST(CASE WHEN pc.code = d.code THEN 1.0 ELSE 0.0 END AS DOUBLE) AS v
FROM pc CROSS JOIN d
""")
def q_one_hot_encode(spark, sf):
    p, key, d = _part_codes(spark, sf)
    oh = encode.one_hot_encode(p, key, d, "oh")
    return oh.select("p_partkey", F.posexplode("oh").alias("j", "v")) \
        .select("p_partkey", F.col("j").cast("long").alias("j"), "v")


@query("one_hot_numeric", f"""
WITH d AS (SELECT value, CAST(row_number() OVER (ORDER BY first) - 1 AS BIGINT) AS code
           FROM (SELECT CAST(CAST(label AS DOUBLE) AS VARCHAR) AS value, min(vec_id) AS first
                 FROM embeddings GROUP BY 1) t),
ec AS (SELECT vec_id, d.code FROM embeddings JOIN d ON CAST(CAST(label AS DOUBLE) AS VARCHAR) = d.value)
SELECT vec_id, d.code AS j, CAST(CASE WHEN ec.code = d.code THEN 1.0 ELSE 0.0 END AS DOUBLE) AS v
FROM ec CROSS JOIN d
""")
def q_one_hot_numeric(spark, sf):
    e = tbl(spark, sf, "embeddings", ["vec_id", "label"])
    key = encode.numeric_key(F.col("label"))
    d = encode.fit_dictionary(e, key, "vec_id")
    oh = encode.one_hot_encode(e, key, d, "oh")
    return oh.select("vec_id", F.posexplode("oh").alias("j", "v")) \
        .select("vec_id", F.col("j").cast("long").alias("j"), "v")


def cells_sql(src: str, key: str = "row_id") -> str:
    """SQL snippet: explode x and y arrays of ``src`` into (row_id, part, j, v)."""
    return f"""
SELECT {key} AS row_id, 'x' AS part, CAST(unnest(range(0, len(x))) AS BIGINT) AS j, unnest(x) AS v FROM {src}
UNION ALL
SELECT {key} AS row_id, 'y' AS part, CAST(unnest(range(0, len(y))) AS BIGINT) AS j, unnest(y) AS v FROM {src}"""


def dataset_cells(d: ds.Dataset):
    x = d.df.select("row_id", F.lit("x").alias("part"), F.posexplode("x").alias("j", "v"))
    y = d.df.select("row_id", F.lit("y").alias("part"), F.posexplode("y").alias("j", "v"))
    return x.unionByName(y).select("row_id", "part", F.col("j").cast("long").alias("j"), r4("v").alias("v"))


@query("to_dataset", f"""
WITH ds AS {_dict_sql('orders', 'o_orderstatus', 'o_orderkey')},
dt AS {_dict_sql('orders', 'o_orderpriority', 'o_orderkey')},
k AS (SELECT count(*) AS k FROM dt),
t AS (
  SELECT o_orderkey,
         [CAST(o_custkey AS DOUBLE), o_totalprice, CAST(ds.code AS DOUBLE)] AS x,
         list_transform(range(0, (SELECT k FROM k)), lambda i: CASE WHEN i = dt.code THEN 1.0 ELSE 0.0 END) AS y
  FROM orders JOIN ds ON o_orderstatus = ds.value JOIN dt ON o_orderpriority = dt.value),
c AS ({cells_sql('t', 'o_orderkey')})
SELECT row_id, part, j, {R('v')} AS v FROM c
""")
def q_to_dataset(spark, sf):
    o = tbl(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                  "o_orderpriority"])
    d = ds.to_dataset(o, "o_orderpriority", numeric=["o_custkey", "o_totalprice"],
                      strings=["o_orderstatus", "o_orderpriority"], key="o_orderkey")
    return dataset_cells(d)


@query("to_image_dataset", f"""
WITH dl AS (SELECT value, CAST(row_number() OVER (ORDER BY first) - 1 AS BIGINT) AS code
            FROM (SELECT CAST(CAST(label AS DOUBLE) AS VARCHAR) AS value, min(vec_id) AS first
                  FROM embeddings GROUP BY 1) t0),
k AS (SELECT count(*) AS k FROM dl),
e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS px, dl.code
      FROM embeddings JOIN dl ON CAST(CAST(label AS DOUBLE) AS VARCHAR) = dl.value),
t AS (SELECT vec_id,
             list_transform(range(0, 64), lambda i: px[(i // 32) + 2 * (i % 32) + 1]) AS x,
             list_transform(range(0, (SELECT k FROM k)), lambda i: CASE WHEN i = code THEN 1.0 ELSE 0.0 END) AS y
      FROM e),
c AS ({cells_sql('t', 'vec_id')})
SELECT row_id, part, j, {R('v')} AS v FROM c
""")
def q_to_image_dataset(spark, sf):
    e = tbl(spark, sf, "embeddings", ["vec_id", "embedding", "label"])
    d = ds.to_image_dataset(e, "embedding", "label", (2, 4, 8), key="vec_id")
    return dataset_cells(d)


SHUF_SQL = "row_number() OVER (ORDER BY md5('{seed}:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1"


@query("seeded_shuffle", f"SELECT o_orderkey, CAST({SHUF_SQL.format(seed=42)} AS BIGINT) AS pos FROM orders")
def q_seeded_shuffle(spark, sf):
    o = tbl(spark, sf, "orders", ["o_orderkey"])
    return split.shuffle_positions(o, "o_orderkey", 42)


@query("train_test_split", f"""
WITH r AS (SELECT o_orderkey, {SHUF_SQL.format(seed=42)} AS pos FROM orders),
k AS (SELECT CAST(round(0.25 * count(*)) AS BIGINT) AS k FROM orders)
SELECT o_orderkey, CASE WHEN pos < k THEN 'test' ELSE 'train' END AS split FROM r, k
""")
def q_train_test_split(spark, sf):
    o = tbl(spark, sf, "orders", ["o_orderkey"])
    return split.split_labels(o, "o_orderkey", 0.25, 42)


@query("batch_gather", f"""
SELECT o_orderkey, CAST(floor(({SHUF_SQL.format(seed=7)}) / 1000) AS BIGINT) AS batch FROM orders
""")
def q_batch_gather(spark, sf):
    o = tbl(spark, sf, "orders", ["o_orderkey"])
    return split.with_batches(o, "o_orderkey", 7, 1000)


@query("positional_gather", f"""
SELECT o_orderkey, CAST(pos AS BIGINT) AS pos FROM (SELECT o_orderkey, {SHUF_SQL.format(seed=7)} AS pos FROM orders)
WHERE pos >= 100 AND pos < 900
""")
def q_positional_gather(spark, sf):
    o = tbl(spark, sf, "orders", ["o_orderkey"])
    return split.gather(o, "o_orderkey", 7, 100, 900)


@query("describe_numeric_nan", f"""
WITH ev AS (SELECT CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value FROM events)
SELECT 'value' AS feature, count(value) AS count, {R('avg(value)')} AS mean, {R('stddev_samp(value)')} AS std,
       {R('min(value)')} AS min, {R('max(value)')} AS max, {R('median(value)')} AS median
FROM ev
""")
def q_describe_numeric_nan(spark, sf):
    """A table that did not come from ``read_csv``: NaN is missing."""
    from tessera.operators import profile
    ev = events_with_nan(spark, sf)
    d = profile.describe_numeric(ev, ["value"])
    med = profile.medians(ev, ["value"])["value"]
    return d.select(F.col("column").alias("feature"), "count", r4("mean").alias("mean"), r4("std").alias("std"),
                    r4("min").alias("min"), r4("max").alias("max"),
                    r4(F.lit(med).cast("double")).alias("median"))


@query("impute_mean_nan", f"""
WITH ev AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value FROM events)
SELECT event_id, {R('coalesce(value, (SELECT avg(value) FROM ev))')} AS value FROM ev
""")
def q_impute_mean_nan(spark, sf):
    from tessera.operators import impute
    ev = events_with_nan(spark, sf)
    return impute.fit_imputer(ev, ["value"], "mean").transform(ev).select("event_id", r4("value").alias("value"))


@query("one_hot_bigint", """
WITH t AS (SELECT o_orderkey AS row_id, 9007199254740992 + o_custkey % 5 AS y FROM orders),
d AS (SELECT y, row_number() OVER (ORDER BY min(row_id)) - 1 AS code FROM t GROUP BY y)
SELECT row_id, CAST(y AS BIGINT) AS y, CAST(code AS INTEGER) AS code FROM t JOIN d USING (y)
""")
def q_one_hot_bigint(spark, sf):
    """Classes that are integers above 2**53 stay apart."""
    from tessera.operators import encode
    o = tbl(spark, sf, "orders", ["o_orderkey", "o_custkey"]).select(
        F.col("o_orderkey").alias("row_id"), (F.lit(9007199254740992) + F.col("o_custkey") % 5).alias("y"))
    key = encode.numeric_key(F.col("y"), "bigint")
    return encode.label_encode(o, key, encode.fit_dictionary(o, key)).select("row_id", "y", F.col("code").cast("int").alias("code"))


def events_with_nan(spark, sf):
    e = tbl(spark, sf, "events", ["event_id", "value"])
    return e.withColumn("value", F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value")))


@query("describe_numeric_missing", f"""
WITH {EV_SQL}
SELECT 'value' AS feature, count(value) AS count, {R('avg(value)')} AS mean, {R('stddev_samp(value)')} AS std,
       {R('min(value)')} AS min, {R('max(value)')} AS max, {R('median(value)')} AS median
FROM ev
""")
def q_describe_numeric_missing(spark, sf):
    """Numeric profile and median of a column with missing values (skipped)."""
    from tessera.operators import profile
    ev = events_with_missing(spark, sf)
    d = profile.describe_numeric(ev, ["value"])
    med = profile.medians(ev, ["value"])["value"]
    return d.select(F.col("column").alias("feature"), "count", r4("mean").alias("mean"), r4("std").alias("std"),
                    r4("min").alias("min"), r4("max").alias("max"),
                    r4(F.lit(med).cast("double")).alias("median"))


@query("describe_string_missing", f"""
WITH {EV_SQL},
vc AS (SELECT event_type AS value, count(*) AS n FROM ev WHERE event_type IS NOT NULL GROUP BY event_type),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, value ASC) AS rk FROM vc)
SELECT 'event_type' AS feature, CAST(sum(n) AS BIGINT) AS count, CAST(count(*) AS BIGINT) AS n_unique,
       max(CASE WHEN rk = 1 THEN value END) AS top, CAST(max(n) AS BIGINT) AS freq
FROM r
""")
def q_describe_string_missing(spark, sf):
    from tessera.operators import profile
    d = profile.describe_string(events_with_missing(spark, sf), ["event_type"])
    return d.select(F.col("column").alias("feature"), "count", F.col("unique").alias("n_unique"), "top", "freq")


@query("label_encode_missing", f"""
WITH {EV_SQL},
d AS {_dict_sql('ev', 'event_type', 'event_id')}
SELECT event_id, d.code AS code FROM ev JOIN d ON COALESCE(CAST(event_type AS VARCHAR), 'nan') = d.value
""")
def q_label_encode_missing(spark, sf):
    """Missing strings are the ordinary category 'nan' in first-appearance order."""
    ev = events_with_missing(spark, sf)
    key = encode.category_key(F.col("event_type"))
    d = encode.fit_dictionary(ev, key, "event_id")
    return encode.label_encode(ev, key, d).select("event_id", F.col("code").cast("long").alias("code"))


CUSTOMER_CODES = """d AS (SELECT o_custkey, CAST(row_number() OVER (ORDER BY min(o_orderkey)) - 1 AS BIGINT) AS code
  FROM orders GROUP BY 1)"""


def _customer_one_hot(spark, sf):
    """Orders with the sparse one-hot vector of their customer: one class a customer."""
    o = tbl(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    key = encode.numeric_key(F.col("o_custkey"), "bigint")
    return sparse.one_hot_encode(o, key, encode.fit_dictionary(o, key, "o_orderkey"), "x")


@query("one_hot_sparse", f"""
WITH {CUSTOMER_CODES}
SELECT o_orderkey, (SELECT count(*) FROM d) AS size, code AS k, CAST(1.0 AS DOUBLE) AS v
FROM orders JOIN d USING (o_custkey)
""")
def q_one_hot_sparse(spark, sf):
    x = _customer_one_hot(spark, sf).withColumn("size", F.col("x.size"))
    return sparse.entries(x, ["o_orderkey", "size"], "x")


@query("one_hot_product", f"""
WITH {CUSTOMER_CODES}
SELECT o_orderkey, CAST(j AS BIGINT) AS j, CAST((code * 7 + j * 3) % 11 AS DOUBLE) * 0.5 AS v
FROM orders JOIN d USING (o_custkey), range(2) r(j)
""")
def q_one_hot_product(spark, sf):
    """One-hot rows, scaled by a half, times a matrix with a row for each class (M6)."""
    x = _customer_one_hot(spark, sf)
    classes = x.select(F.explode("x.indices").alias("i")).distinct()
    b = classes.withColumn("j", F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))))
    b = b.withColumn("v", ((F.col("i") * 7 + F.col("j") * 3) % 11).cast("double"))
    x = x.withColumn("x", sparse.scale(F.col("x"), 0.5))
    return sparse.matmul(x, ["o_orderkey"], "x", b, 2 * tbl(spark, sf, "customer", ["c_custkey"]).count())


@query("one_hot_gram", f"""
WITH {CUSTOMER_CODES}
SELECT code AS i, CAST(0 AS BIGINT) AS j, CAST(sum(o_orderkey % 7) AS DOUBLE) AS v FROM orders JOIN d USING (o_custkey)
GROUP BY 1
UNION ALL SELECT code, 1, CAST(count(*) AS DOUBLE) FROM orders JOIN d USING (o_custkey) GROUP BY 1
""")
def q_one_hot_gram(spark, sf):
    """Two column sums by class: the transposed one-hot matrix times two columns (M7)."""
    x = _customer_one_hot(spark, sf)
    return sparse.gram(x.withColumn("y", F.array((F.col("o_orderkey") % 7).cast("double"), F.lit(1.0))), "x", "y")


@query("split_repeated_keys", """
WITH r AS (SELECT l_suppkey, md5(concat('5:', CAST(l_suppkey AS VARCHAR))) AS h FROM lineitem),
k AS (SELECT CAST(round(0.3 * count(*)) AS BIGINT) AS k FROM r),
s AS (SELECT l_suppkey, h, count(*) AS n FROM r GROUP BY 1, 2),
c AS (SELECT l_suppkey, n, coalesce(sum(n) OVER (ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM s)
SELECT l_suppkey, CAST(greatest(0, least(n, k - before)) AS BIGINT) AS test,
       CAST(n - greatest(0, least(n, k - before)) AS BIGINT) AS train FROM c, k
""")
def q_split_repeated_keys(spark, sf):
    """Rows of a supplier on either side of a split by a key that many rows share."""
    li = tbl(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey"])
    both = split.split_labels(li, "l_suppkey", 0.3, 5)
    return both.groupBy("l_suppkey").agg(F.count_if(F.col("split") == "test").alias("test"),
                                         F.count_if(F.col("split") == "train").alias("train"))
