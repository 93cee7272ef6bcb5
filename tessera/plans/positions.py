"""Reproducible order and contiguous positions without a global sort.

A DataFrame has no row order, so every positional operator (shuffle, exact
split, batch gather, first-appearance codes) is defined on an explicit key.
The seeded permutation orders rows by ``(md5(seed || ':' || key), key)``;
DuckDB computes the same md5 hex, so the order is checkable with SQL.

Never ``row_number() over (order by ...)`` on data-sized input: that plans a
single partition. Instead rows are bucketed by a prefix of the order key
(uniform for md5), counts per bucket (a bounded table) give offsets, and ranks
are only computed inside one bucket at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.joins import lookup_join
from tessera.session import scratch_path

HEX_DIGITS = 4          # 65,536 buckets per refinement level
FINAL_ROWS = 100_000    # at most this many rows are ranked on the driver


def order_hash(seed: int, key: str = "row_id"):
    """md5 hex of ``seed:key`` (the permutation key)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def kth_key(df: DataFrame, h: str, key: str, k: int):
    """The ``(h, key)`` pair of the k-th row (0-based) in ``(h, key)`` order.

    Refines by successive hex prefixes of ``h``: each level is one grouped
    count over at most 65,536 prefixes (partial aggregation, so hot values
    cannot overload a task), restricted to the prefix chosen so far. When the
    chosen prefix holds at most ``FINAL_ROWS`` rows they are collected and
    ranked exactly.
    """
    cur = df.select(h, key)
    prefix, below = "", 0
    while len(prefix) < 32:
        part = cur.filter(F.col(h).startswith(prefix)) if prefix else cur
        counts = (part.groupBy(F.substring(h, len(prefix) + 1, HEX_DIGITS).alias("p"))
                  .count().collect())
        for p, n in sorted((r[0], r[1]) for r in counts):
            if below + n > k:
                prefix += p
                if n <= FINAL_ROWS:
                    rows = sorted((r[0], r[1]) for r in
                                  cur.filter(F.col(h).startswith(prefix)).collect())
                    return rows[k - below]
                break
            below += n
        else:
            raise ValueError("rank beyond the row count")
    raise RuntimeError("md5 prefixes exhausted")


def kth_value(df: DataFrame, h: str, k: int) -> tuple[str, int, int]:
    """``(value, before, run)``: the hash of the k-th row (0-based) in ``h`` order,
    how many rows have a smaller one and how many have this one. Like ``kth_key``,
    but rows of equal hash are one run, however long: once a prefix holds at most
    ``FINAL_ROWS`` rows, or is a whole hash, its hashes are counted."""
    prefix, below = "", 0
    while True:
        part = df.where(F.col(h).startswith(prefix)) if prefix else df
        counts = part.groupBy(F.substring(h, len(prefix) + 1, HEX_DIGITS).alias("p")).agg(F.count(F.lit(1)).alias("n"))
        for p, n in sorted((r["p"], r["n"]) for r in counts.collect()):
            if below + n > k:
                prefix += p
                break
            below += n
        else:
            raise ValueError("rank beyond the row count")
        if len(prefix) >= 32:
            return prefix, below, n
        if n <= FINAL_ROWS:
            counts = df.where(F.col(h).startswith(prefix)).groupBy(h).agg(F.count(F.lit(1)).alias("n"))
            for v, n in sorted((r[h], r["n"]) for r in counts.collect()):
                if below + n > k:
                    return v, below, n
                below += n


def before_key(h: str, key: str, cut) -> "F.Column":
    """Predicate ``(h, key) < cut`` (lexicographic)."""
    ch, ck = cut
    return (F.col(h) < F.lit(ch)) | ((F.col(h) == F.lit(ch)) & (F.col(key) < F.lit(ck)))


TARGET_BUCKET_ROWS = 2_000_000   # rows ranked by one task at most (beyond one fine bucket)


def coarse_mapping(b: DataFrame, parallelism: int) -> DataFrame:
    """``(_fine, _bucket, _offset)``: consecutive fine buckets merged into
    coarse ones of about ``min(TARGET_BUCKET_ROWS, total / (2 * parallelism))``
    rows, with the number of rows before each coarse bucket. Computed on the
    fine-bucket count table (at most 65,536 rows), so its un-partitioned
    windows are bounded and nothing goes through the driver."""
    counts = b.groupBy("_fine").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_fine").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    cum = F.coalesce(F.sum("_n").over(before), F.lit(0))
    target = F.greatest(F.lit(1), F.least(F.lit(TARGET_BUCKET_ROWS),
                                          F.ceil(F.sum("_n").over(whole) / F.lit(2 * max(1, parallelism)))))
    m = counts.select("_fine", cum.alias("_cum"), target.alias("_target"))
    m = m.withColumn("_bucket", F.floor(F.col("_cum") / F.col("_target")).cast("long"))
    return m.select("_fine", "_bucket",
                    F.min("_cum").over(Window.partitionBy("_bucket")).cast("long").alias("_offset"))


def contiguous_positions(df: DataFrame, order_cols: list[str], bucket_expr,
                         pos_col: str = "pos", ordered_output: bool = False) -> DataFrame:
    """0-based contiguous position in ``order_cols`` order.

    ``bucket_expr`` must be monotone in the order with a bounded number of
    values (a 4-hex-digit md5 prefix, or a quantile bucket). Its count table
    (map-side combined, at most 65,536 rows) is merged into coarse buckets
    sized for the data and the cluster; each coarse bucket is ranked by its own
    task (a window partitioned by bucket), and
    ``position = offset(bucket) + rank inside bucket``.

    With ``ordered_output`` the rows are range-partitioned on the bucket
    (which also clusters them for the window, so there is still one exchange)
    and come out in position order across and within partitions - ready for
    a write whose files and row groups cover disjoint position ranges.
    """
    spark = df.sparkSession
    b = df.withColumn("_fine", bucket_expr)
    mapping = coarse_mapping(b, spark.sparkContext.defaultParallelism)
    # the mapping has one row per fine bucket (<= 65,536): broadcasting it is bounded
    j = b.join(F.broadcast(mapping), "_fine")
    if ordered_output:
        j = j.repartitionByRange("_bucket")
    w = Window.partitionBy("_bucket").orderBy(*order_cols)
    return (j.withColumn(pos_col, (F.col("_offset") + F.row_number().over(w) - 1).cast("long"))
            .drop("_fine", "_bucket", "_offset"))


def md5_bucket(h: str, digits: int = HEX_DIGITS):
    """Integer value of the first ``digits`` hex digits of an md5 column."""
    return F.conv(F.substring(F.col(h), 1, digits), 16, 10).cast("int")


def prefix_digits(n: int) -> int:
    """Hex digits of the fine md5 bucket: 4 (65,536 buckets), or 5 (1M buckets)
    beyond 65,536 x ``TARGET_BUCKET_ROWS`` rows, which keeps the table of buckets
    small and a bucket at about 2M rows up to 2 x 10^12 rows."""
    return HEX_DIGITS + (n > (16 ** HEX_DIGITS) * TARGET_BUCKET_ROWS)


def positions_by_key(df: DataFrame, key: str, pos_col: str = "pos", rows_per_task: int = TARGET_BUCKET_ROWS) -> DataFrame:
    """0-based contiguous position in ``key`` order (any orderable key; repeated
    keys take consecutive positions). One range exchange into as many partitions as the rows
    need, each sorted and written with its rows' places in it; the counts of the
    partitions (one row each) give their offsets. No partition has a window, and
    their number follows the row count."""
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, -(-df.count() // rows_per_task))
    ranged = df.repartitionByRange(parts, F.col(key).asc_nulls_first()).sortWithinPartitions(F.col(key).asc_nulls_first())
    path = scratch_path(spark, "positions")
    # the id is (partition << 33) + place in the partition
    ranged.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path).withColumn("_part", F.shiftright("_place", 33))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)     # one row a partition
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    j = lookup_join(placed, offsets, ["_part"], parts, how="inner")
    position = F.col("_offset") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return j.select(*df.columns, position.cast("long").alias(pos_col))
