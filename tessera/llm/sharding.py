"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair has a hash u in (0, 1); a key goes to the shard with the
largest -weight / ln(u). The choice depends on the key and the shards alone, and
a new shard takes only the keys for which it wins, from no shard to another.

The place of a record in its shard (slot) follows the md5 order of the key. It
is found without a sort of a whole shard: counts per md5 prefix give each prefix
its first slot, and rows are ranked inside a prefix only. Equal rows are one row
with a count until their slots are dealt, so a hot key is no hot group.

DataFrame functions only. Defined results: a null key is the key "" and has its
own shard like any other; null texts have size 1 and the checksum of no bytes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 4096     # rows aimed at for one md5 prefix of one shard


def unit_hash(key: Column, shard: int) -> Column:
    """In (0, 1): the first 13 hex digits of md5(key:shard), 52 bits."""
    h = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, 13), 16, 10).cast("double")
    return (h + 0.5) / float(2 ** 52)


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard of a key; equal scores go to the smaller shard."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    best = [F.struct((F.lit(float(w)) / -F.log(unit_hash(key, s))).alias("score"), F.lit(-s).alias("shard"))
            for s, w in enumerate(weights)]
    return -(F.greatest(*best)["shard"] if len(best) > 1 else best[0]["shard"])


def shard(df: DataFrame, weights: list[float], id_col: str = "doc_id", text_col: str = "text",
          rows: int | None = None) -> DataFrame:
    """Per row doc_id, size, text_crc32, law, shard, slot, grown_shard (the shard
    when one more of weight 1 is there). ``rows``: the row count, if known."""
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    flat = df.select(F.col(id_col).alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"),
                     F.crc32(raw).alias("text_crc32"))
    n = rows if rows is not None else df.select(F.lit(1)).count()
    digits = min(6, max(1, math.ceil(math.log(max(1, n / (len(weights) * BUCKET_ROWS)), 16))))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    one = flat.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    grown = weights + [1.0]
    one = (one.withColumn("shard", rendezvous(key, weights)).withColumn("grown_shard", rendezvous(key, grown))
           .withColumn("place", F.md5(key)).withColumn("prefix", F.substring("place", 1, digits)))
    per = one.groupBy("shard", "prefix").agg(F.sum("copies").alias("n"))
    first = Window.partitionBy("shard").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("shard", "prefix", F.coalesce(F.sum("n").over(first), F.lit(0)).alias("first"))
    inside = (Window.partitionBy("shard", "prefix").orderBy("place", "doc_id", "size", "text_crc32")
              .rowsBetween(Window.unboundedPreceding, -1))
    ranked = one.join(per, ["shard", "prefix"]).withColumn(
        "from", F.col("first") + F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    return ranked.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int"),
                         F.explode(F.sequence(F.col("from"), F.col("from") + F.col("copies") - 1)).alias("slot"),
                         F.col("grown_shard").cast("int"))
