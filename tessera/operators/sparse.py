"""Sparse vectors as columns: ``struct<size, indices, values>``.

A one-hot row of k classes is its one index, whatever k, so a million classes
cost no more than two. Indices are ascending and distinct, below ``size``; what
is not listed is 0. Row operations are expressions over the two short arrays;
products go over the listed entries only, as joins and grouped sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.encode import Dictionary, label_encode
from tessera.plans.joins import lookup_join

TYPE = "struct<size:bigint,indices:array<bigint>,values:array<double>>"


def one_hot(code: Column, k: int) -> Column:
    """1.0 at ``code``; nothing listed for a code that is -1 or NULL."""
    seen = (code >= 0) & (code < k)
    return F.struct(F.lit(k).cast("long").alias("size"),
                    F.when(seen, F.array(code.cast("long"))).otherwise(F.array().cast("array<bigint>")).alias("indices"),
                    F.when(seen, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"))


def one_hot_encode(df: DataFrame, value: Column, dic: Dictionary, out: str = "onehot") -> DataFrame:
    """Append the sparse one-hot vector of ``value`` (unseen: nothing listed)."""
    hidden = "_code"
    while hidden in df.columns:
        hidden = "_" + hidden
    return label_encode(df, value, dic, hidden).withColumn(out, one_hot(F.col(hidden), dic.size)).drop(hidden)


def from_dense(x: Column) -> Column:
    """The entries of ARRAY<DOUBLE> that are not 0."""
    pairs = F.filter(F.transform(x, lambda v, i: F.struct(i.cast("long").alias("i"), v.alias("v"))),
                     lambda p: p["v"].isNull() | (p["v"] != 0))
    return F.struct(F.size(x).cast("long").alias("size"), F.transform(pairs, lambda p: p["i"]).alias("indices"),
                    F.transform(pairs, lambda p: p["v"]).alias("values"))


def to_dense(v: Column) -> Column:
    """ARRAY<DOUBLE> of the vector's size; for sizes that fit a row."""
    entries = F.map_from_arrays(v["indices"], v["values"])
    dense = F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(v["size"] - 1, F.lit(0))),
                        lambda i: F.coalesce(F.element_at(entries, i), F.lit(0.0)))
    return F.when(v["size"] == 0, F.array().cast("array<double>")).otherwise(dense)


def scale(v: Column, s: float) -> Column:
    return F.struct(v["size"].alias("size"), v["indices"].alias("indices"),
                    F.transform(v["values"], lambda x: x * F.lit(float(s))).alias("values"))


def dot(a: Column, b: Column) -> Column:
    """Inner product of two sparse vectors; sizes that differ fail the job."""
    other = F.map_from_arrays(b["indices"], b["values"])
    terms = F.zip_with(a["indices"], a["values"], lambda i, x: x * F.coalesce(F.element_at(other, i), F.lit(0.0)))
    total = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return F.when(a["size"] == b["size"], total).otherwise(
        F.raise_error(F.lit("shape mismatch: vectors of different sizes")).cast("double"))


def entries(df: DataFrame, keys: list[str], v: str) -> DataFrame:
    """(keys, k, v): one row for each listed entry."""
    pairs = F.arrays_zip(F.col(f"{v}.indices").alias("i"), F.col(f"{v}.values").alias("x"))
    return df.select(*keys, F.explode(pairs).alias("_e")).select(
        *keys, F.col("_e.i").alias("k"), F.col("_e.x").alias("v"))


def matmul(df: DataFrame, keys: list[str], v: str, b: DataFrame, b_cells: int) -> DataFrame:
    """Sparse rows times the cells (i, j, v) of B -> (keys, j, v), M6: each listed
    entry meets row k of B. ``b_cells`` is B's exact cell count: below the bound
    of a lookup B is broadcast, above it joined by salted shuffle."""
    left = entries(df, keys, v).withColumnRenamed("v", "_a")
    right = b.groupBy(F.col("i").alias("k")).agg(F.collect_list(F.struct("j", F.col("v").alias("_b"))).alias("_row"))
    j = lookup_join(left, right, ["k"], b_cells).where(F.col("_row").isNotNull())
    j = j.select(*keys, "_a", F.inline("_row"))
    return j.groupBy(*keys, "j").agg(F.sum(F.col("_a") * F.col("_b")).alias("v"))


def gram(df: DataFrame, v: str, y: str) -> DataFrame:
    """XᵀY (M7) of sparse rows ``v`` and dense rows ``y`` -> cells (i, j, v): each
    listed entry times its row's y, summed by class (partial sums first, so a
    class with a third of the rows is no hot spot)."""
    e = df.select(F.explode(F.arrays_zip(F.col(f"{v}.indices").alias("i"), F.col(f"{v}.values").alias("x"))).alias("_e"),
                  F.col(y).alias("_y"))
    e = e.select(F.col("_e.i").alias("i"), F.col("_e.x").alias("_x"), F.posexplode("_y").alias("j", "_v"))
    return (e.groupBy("i", "j").agg(F.sum(F.col("_x") * F.col("_v")).alias("v"))
            .select("i", F.col("j").cast("long").alias("j"), "v"))
