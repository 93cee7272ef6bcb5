"""Counts, minima and maxima from Parquet footers.

Spark's second-generation Parquet source answers COUNT, MIN and MAX from the
statistics of the row groups, without reading a value. Spark asks for exact types
only; columns are limited here to those whose statistics are exact in every
writer: integers, dates and booleans. Floating-point statistics may leave out NaN
and strings may be cut, so those columns are profiled by a scan
(``operators.profile``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, ByteType, DateType, IntegerType, LongType, ShortType

EXACT_TYPES = (ByteType, ShortType, IntegerType, LongType, DateType, BooleanType)
V1_SOURCES = "spark.sql.sources.useV1SourceList"
PUSHDOWN = "spark.sql.parquet.aggregatePushdown"


def read_parquet_v2(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table through the source that can push aggregates into footers.
    The source is chosen when the table is opened, so the session's list of
    first-generation sources is put back at once."""
    before = spark.conf.get(V1_SOURCES)
    try:
        spark.conf.set(V1_SOURCES, ",".join(s for s in before.split(",") if s.strip() != "parquet"))
        return spark.read.parquet(path)
    finally:
        spark.conf.set(V1_SOURCES, before)


def footer_profile(spark: SparkSession, path: str, cols: list[str]) -> DataFrame:
    """One row: ``n`` rows and, per column, ``<c>_count`` (not NULL), ``<c>_min`` and
    ``<c>_max``. An empty table has counts 0 and NULL bounds. Raises for a column
    whose footers need not be exact."""
    df = read_parquet_v2(spark, path)
    for c in cols:
        if not isinstance(df.schema[c].dataType, EXACT_TYPES):
            raise ValueError(f"{c}: footers of {df.schema[c].dataType.simpleString()} columns are not exact, use describe_numeric")
    # read when the plan is made; it concerns second-generation scans only
    spark.conf.set(PUSHDOWN, "true")
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        aggs += [F.count(c).alias(f"{c}_count"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    wide = df.agg(*aggs)
    # with no row group at all, Spark's sum of pushed counts is empty
    return wide.select(*[F.greatest(F.col(c), F.lit(0).cast("long")).alias(c) if c == "n" or c in {f"{x}_count" for x in cols}
                         else F.col(c) for c in wide.columns])
