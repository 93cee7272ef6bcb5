"""Seeded shuffle, exact train/test split, batch numbers and gathers
(P18-P20).

The permutation is the order of ``(md5(seed || ':' || key), key)`` - the same
for any partitioning, any number of executors, and in DuckDB. The exact split
needs only the k-th hash of that order (``plans.positions.kth_value``), after
which test and train are narrow filters: no shuffle and no sort of the data.

Keys may repeat. Rows of one key are a run of equal hashes; the one run that the
cut falls into is ordered by a hash of the rows' content, and of rows equal in
content as many as are wanted are taken, counted and not ranked. So the test set
has exactly ``round(test_size * n)`` rows, whatever the keys, and the same rows
in every run. A NULL key counts as a key of its own.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.positions import (before_key, contiguous_positions, kth_key, kth_value,
                                     md5_bucket, order_hash, prefix_digits)


def round_half_away(x: float) -> int:
    return int(math.floor(abs(x) + 0.5)) * (1 if x >= 0 else -1)


def with_order_hash(df: DataFrame, key: str, seed: int, h: str = "_h") -> DataFrame:
    return df.withColumn(h, order_hash(seed, key))


def shuffle_positions(df: DataFrame, key: str, seed: int, pos: str = "pos",
                      ordered_output: bool = False, n: int | None = None) -> DataFrame:
    """Append the 0-based position of each row in the seeded permutation
    (``ordered_output``: rows also come out in permutation order; ``n``, the row
    count, sizes the md5 buckets and is counted unless given)."""
    n = df.count() if n is None else n
    h = with_order_hash(df, key, seed)
    bucket = md5_bucket("_h", prefix_digits(n))
    return contiguous_positions(h, ["_h", key], bucket, pos, ordered_output).drop("_h")


COPIES = 1 << 16        # rows that one row is repeated to at once


def repeated(df: DataFrame, n: int) -> DataFrame:
    """Every row n times, dealt to tasks in runs of at most ``COPIES``."""
    if n <= COPIES:
        return df.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("_n") if n else df.limit(0)
    runs = df.withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit((n - 1) // COPIES)))).repartition("_r")
    of = F.least(F.lit(COPIES), F.lit(n) - F.col("_r") * COPIES)
    return runs.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), of.cast("long")))).drop("_n", "_r")


def _content(df: DataFrame) -> "F.Column":
    """md5 of all columns; equal for rows that are equal."""
    return F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}))


def _cut(df: DataFrame, key: str, test_size: float, seed: int, n: int | None, out: str) -> DataFrame:
    """``df`` with the column ``out``: 'test' for the first rows of the order."""
    if not 0 <= test_size <= 1:
        raise ValueError("test_size must be in [0, 1]")
    n = df.count() if n is None else n
    k = round_half_away(test_size * n)
    if k == 0 or k >= n:
        return df.withColumn(out, F.lit("test" if k else "train"))
    h = df.withColumn("_h", F.coalesce(order_hash(seed, key), F.md5(F.lit(f"{seed}"))))
    value, before, _ = kth_value(h.select("_h"), "_h", k)
    label = F.when(F.col("_h") < value, "test").otherwise("train")
    if before == k:                         # the run starts where the test set ends
        return h.withColumn(out, label).drop("_h")
    within = h.where(F.col("_h") == value).drop("_h").withColumn("_c", _content(df))
    content, earlier, same = kth_value(within, "_c", k - before)
    inside = within.where(F.col("_c") != content)
    inside = inside.withColumn(out, F.when(F.col("_c") < content, "test").otherwise("train")).drop("_c")
    parts = [h.where(F.col("_h") != value).withColumn(out, label).drop("_h"), inside]
    tied = within.where(F.col("_c") == content).drop("_c")
    taken = k - before - earlier
    if taken == 0:
        parts.append(tied.withColumn(out, F.lit("train")))
    else:                                   # equal rows: one of them, as often as either side needs it
        one = tied.limit(1)
        parts += [repeated(one, c).withColumn(out, F.lit(v)) for c, v in ((taken, "test"), (same - taken, "train")) if c]
    return reduce(DataFrame.unionByName, parts)


def train_test_split(df: DataFrame, key: str, test_size: float, seed: int,
                     n: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly ``round(test_size * n)`` test rows: the first
    rows of the seeded permutation are the test set."""
    name = "_split"
    while name in df.columns:
        name = "_" + name
    both = _cut(df, key, test_size, seed, n, name)
    return both.where(F.col(name) == "train").drop(name), both.where(F.col(name) == "test").drop(name)


def split_labels(df: DataFrame, key: str, test_size: float, seed: int,
                 n: int | None = None, out: str = "split") -> DataFrame:
    """The same split as a ``'train'``/``'test'`` column."""
    return _cut(df, key, test_size, seed, n, out)


def with_batches(df: DataFrame, key: str, seed: int, batch_size: int,
                 batch: str = "batch", ordered_output: bool = False, n: int | None = None) -> DataFrame:
    """Batch number ``floor(pos / batch_size)`` of every row in the seeded
    permutation (mini-batch ``b`` = rows ``order[b*size : (b+1)*size)``)."""
    p = shuffle_positions(df, key, seed, "_pos", ordered_output, n)
    return p.withColumn(batch, F.floor(F.col("_pos") / F.lit(batch_size)).cast("long")).drop("_pos")


def gather(df: DataFrame, key: str, seed: int, begin: int, end: int, pos: str = "pos",
           n: int | None = None) -> DataFrame:
    """Rows ``order[begin:end)`` of the seeded permutation: two cuts in the
    order make the slice a narrow filter; only the slice is ranked."""
    n = df.count() if n is None else n
    begin, end = max(0, begin), min(end, n)
    h = with_order_hash(df, key, seed)
    if begin >= end:
        return h.limit(0).withColumn("_h", F.lit(0).cast("long")).withColumnRenamed("_h", pos)
    inside = F.lit(True)
    if begin:
        inside = inside & ~before_key("_h", key, kth_key(h, "_h", key, begin))
    if end < n:
        inside = inside & before_key("_h", key, kth_key(h, "_h", key, end))
    out = contiguous_positions(h.where(inside), ["_h", key], md5_bucket("_h", prefix_digits(end - begin)), pos)
    return out.withColumn(pos, F.col(pos) + F.lit(begin)).drop("_h")
