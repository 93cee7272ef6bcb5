"""Label / one-hot encoders with first-appearance codes.

Codes follow the order in which values first appear along the row key:
``groupBy(value).agg(min(key))`` (partial aggregation, skew-safe), then the
rank of ``min(key)`` among the *distinct* values. A dictionary under
``DICT_WINDOW_MAX`` entries is ranked with one window (bounded input); larger
ones use range partitions and their offsets (no single-partition sort). Missing strings are the
category ``'nan'``; unseen values get code -1 and an all-zero one-hot row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.joins import lookup_join
from tessera.plans.positions import positions_by_key
from tessera.session import checkpoint_dir

DICT_WINDOW_MAX = 1_000_000


@dataclass
class Dictionary:
    df: DataFrame   # (value STRING, code BIGINT), checkpointed in the shared folder
    size: int

    def codes(self) -> dict[str, int]:
        """Driver copy; only for small dictionaries (tests, model metadata)."""
        if self.size > DICT_WINDOW_MAX:
            raise ValueError("dictionary too large to bring to the driver")
        return {r["value"]: r["code"] for r in self.df.collect()}


def category_key(c: Column) -> Column:
    """Value used as the dictionary key: string form, missing -> 'nan'."""
    return F.coalesce(c.cast("string"), F.lit("nan"))


def numeric_key(c: Column, kind: str = "double") -> Column:
    """Exact numeric value as key. ``kind`` is the column's type: integers and
    decimals are keyed by their own value (no rounding through DOUBLE), -0.0 is
    0.0, and NaN is missing."""
    if kind in ("tinyint", "smallint", "int", "bigint") or kind.startswith("decimal"):
        key = c.cast("string")
    else:
        x = c.cast("double")
        key = F.when(x == 0, F.lit("0.0")).when(~F.isnan(x), x.cast("string"))
    return F.coalesce(key, F.lit("nan"))


def fit_dictionaries(df: DataFrame, values: dict[str, Column], key: str = "row_id") -> dict[str, Dictionary]:
    """First-appearance dictionaries of several columns in one pass.

    ``groupBy(column, value).agg(min(key))`` over the stacked columns (partial
    aggregation: a value that holds a third of the rows is pre-combined in every
    map task), checkpointed once in the shared folder; the per-column sizes
    are one bounded collect. Codes are the rank of ``min(key)`` inside each
    column: a window partitioned by column when every dictionary is under
    ``DICT_WINDOW_MAX`` entries, range partitions and their offsets otherwise. Codes
    are BIGINT.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    names = list(values)
    items = [F.struct(F.lit(n).alias("column"), values[n].alias("value"), F.col(key).alias("_k"))
             for n in names]
    long = df.select(F.inline(F.array(*items)))
    firsts = (long.groupBy("column", "value").agg(F.min("_k").alias("first"))
              .checkpoint(eager=True))
    sizes = {r["column"]: r["n"] for r in firsts.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = {}
    for n in names:
        size = int(sizes.get(n, 0))
        one = firsts.where(F.col("column") == n).select("value", "first")
        if size <= DICT_WINDOW_MAX:
            # bounded: one dictionary of at most DICT_WINDOW_MAX entries per task
            d = one.select("value", (F.row_number().over(Window.orderBy("first")) - 1).cast("long").alias("code"))
        else:
            d = positions_by_key(one, "first", "code").select("value", "code")
        out[n] = Dictionary(d, size)
    return out


def fit_dictionary(df: DataFrame, value: Column, key: str = "row_id") -> Dictionary:
    return fit_dictionaries(df, {"_": value}, key)["_"]


def label_encode(df: DataFrame, value: Column, dic: Dictionary, out: str = "code") -> DataFrame:
    """Append ``out`` = code of ``value`` (-1 when unseen)."""
    src = df.withColumn("_enc_v", value)
    d = dic.df.select(F.col("value").alias("_enc_v"), F.col("code").alias("_enc_c"))
    j = lookup_join(src, d, ["_enc_v"], dic.size)
    return (j.withColumn(out, F.coalesce(F.col("_enc_c"), F.lit(-1)).cast("long"))
            .drop("_enc_v", "_enc_c"))


def one_hot(code: Column, k: int) -> Column:
    """ARRAY<DOUBLE> of length k with 1.0 at ``code`` (all zero for -1)."""
    if k == 0:
        return F.array().cast("array<double>")
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (i == code).cast("double"))


def one_hot_encode(df: DataFrame, value: Column, dic: Dictionary, out: str = "onehot") -> DataFrame:
    enc = label_encode(df, value, dic, "_code")
    return enc.withColumn(out, one_hot(F.col("_code"), dic.size)).drop("_code")
