"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Sources in order of their name (null last) get the weights in turn. Together they
share ``total`` times all words, by weight; a target stops at ``most`` times its
source's words and what is left over is shared again until none is above.

Each source is a stream of its documents in md5 order, repeated; its target is a
run of words from the stream's start, so a document is taken once or twice, and
only the last document of the run is cut. The run is laid out in blocks of equal
length. A splitting tree hands every source's exact number of blocks to the
output shards: at each node the blocks of the left half are one multivariate
hypergeometric draw from those of the node. A shard gets its own interval of
each source's permuted blocks, so shards are disjoint, and rows are shuffled
inside a shard by a hash.

Word positions come from sums per (source, md5 prefix) and a running sum inside
a prefix, so a hot source is spread over all prefixes. The driver holds one row
per source (and its quota per shard); nothing that grows with the documents.

Defined results: a null text has 0 words; a source without words has target 0;
null sources are one source; rows that are equal in id, text and source are
taken in any order. The seed fixes all draws, so reruns agree.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import free_prefix, positional
from tessera.session import scratch_path

BUCKET_ROWS = 256       # rows aimed at for one md5 prefix of one source
WEIGHTS = (5.0, 2.0, 1.0)


def word_count(text):
    """Number of runs of other characters than space, tab, line breaks."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    parts = F.split(t, r"[\x20\x09-\x0D]+")      # an empty part stands at an end only
    ends = F.when(F.octet_length(t) == 0, F.lit(1)).otherwise(
        t.rlike(r"^[\x20\x09-\x0D]").cast("int") + t.rlike(r"[\x20\x09-\x0D]\z").cast("int"))
    return (F.size(parts) - ends).cast("long")


def shared_targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """min(most * size, level * weight) with the level at which they sum to the
    total (capped sources first, in order of the level that caps them)."""
    left, share = total * float(sum(sizes)), float(sum(weights))
    out = [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (most * sizes[i] / weights[i], i))
    for k, i in enumerate(order):
        if most * sizes[i] * share <= left * weights[i]:
            out[i] = most * sizes[i]
            left -= out[i]
            share -= weights[i]
        else:
            for j in order[k:]:
                out[j] = left * weights[j] / share
            break
    return out


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """quotas[source] blocks -> [shard, source], exact in every source; shards
    get block totals that differ by one at most."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def node(q, a, b):
        if b - a == 1:
            out[a] = q
            return
        mid = (a + b) // 2
        n = int(q.sum()) * (mid - a) // (b - a)
        rng = np.random.default_rng([seed, a, b])
        left = rng.multivariate_hypergeometric(q, n, method="marginals") if len(q) else q
        node(left, a, mid)
        node(q - left, mid, b)

    node(np.asarray(quotas, dtype=np.int64), 0, shards)
    return out


def assign(df: DataFrame, weights=WEIGHTS, total: float = 1.5, most: float = 2.0, shards: int = 8,
           blocks_per_shard: int = 64, seed: int = 11, id_col: str = "doc_id", text_col: str = "text",
           source_col: str = "source") -> DataFrame:
    """All columns of ``df`` and, under the prefix ``mix_`` (with more underscores
    before it if a column of ``df`` begins so): size, source_size, target, taken
    (words over all passes), first and again (words of the first and the second
    pass), shard_first, shard_again, order (local shuffle key)."""
    if most > 2:
        raise ValueError("a document is taken twice at most")
    spark, prefix = df.sparkSession, free_prefix("mix_", df.columns)
    df, names = positional(df)
    id_col, text_col, source_col = names[id_col], names[text_col], names[source_col]
    key = F.when(F.col(source_col).isNull(), F.lit("n")).otherwise(
        F.concat(F.lit("s"), F.col(source_col).cast("string")))
    doc = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    base = df.withColumns({"mix_size": word_count(F.col(text_col)), "mix_source": key,
                           "mix_place": F.md5(F.concat(F.lit(f"{seed}:"), doc)),
                           "mix_tie": F.crc32(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))})
    path = scratch_path(spark, "mix")
    (base.groupBy("mix_source", F.substring("mix_place", 1, 4).alias("p4"))
     .agg(F.sum("mix_size").alias("words"), F.count(F.lit(1)).alias("rows")).write.parquet(path))
    sums = spark.read.parquet(path)
    per = sums.groupBy("mix_source").agg(F.sum("words").alias("words"), F.sum("rows").alias("rows")).collect()
    per = sorted(per, key=lambda r: (r.mix_source == "n", r.mix_source.encode("utf-8")))    # one row per source
    sizes = [int(r.words) for r in per]
    targets = shared_targets(sizes, [weights[i % len(weights)] for i in range(len(per))], total, most)
    runs = [min(int(math.floor(t + 0.5)), 2 * s) for t, s in zip(targets, sizes)]
    block = max(1, math.ceil(sum(runs) / (shards * blocks_per_shard)))
    quotas = np.array([-(-r // block) for r in runs], dtype=np.int64)
    cuts = np.cumsum(split_quotas(quotas, shards, seed), axis=0)
    rows = []
    for i, r in enumerate(per):
        rng, q = np.random.default_rng([seed, i]), max(1, int(quotas[i]))
        step = next(a for a in (int(rng.integers(1, q + 1)) + k for k in range(q + 1)) if math.gcd(a, q) == 1)
        rows.append((r.mix_source, sizes[i], targets[i], runs[i], q, step, int(rng.integers(0, q)),
                     [int(c) for c in cuts[:, i]]))
    plan = spark.createDataFrame(rows, "mix_source string, mix_source_size long, mix_target double, mix_run long, "
                                       "mix_q long, mix_step long, mix_shift long, mix_cuts array<long>")
    digits = min(4, max(1, math.ceil(math.log(max([1.0] + [r.rows / BUCKET_ROWS for r in per]), 16))))
    sums = sums.groupBy("mix_source", F.substring("p4", 1, digits).alias("mix_prefix")).agg(F.sum("words").alias("n"))
    before = Window.partitionBy("mix_source").orderBy("mix_prefix").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("mix_source", "mix_prefix", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("mix_from"))
    inside = (Window.partitionBy("mix_source", "mix_prefix").orderBy("mix_place", "mix_tie", "mix_size")
              .rowsBetween(Window.unboundedPreceding, -1))
    out = (base.withColumn("mix_prefix", F.substring("mix_place", 1, digits))
           .withColumn("mix_at", F.coalesce(F.sum("mix_size").over(inside), F.lit(0)))
           .join(sums, ["mix_source", "mix_prefix"]).join(plan, "mix_source"))
    at = F.col("mix_from") + F.col("mix_at")
    size, run = F.col("mix_size"), F.col("mix_run")

    def words(start):
        return F.greatest(F.lit(0), F.least(size, run - start)).cast("long")

    def shard_of(start):
        rank = (F.floor(start / F.lit(block)).cast("long") * F.col("mix_step") + F.col("mix_shift")) % F.col("mix_q")
        return F.least(F.size(F.filter("mix_cuts", lambda c: c <= rank)), F.lit(shards - 1)).cast("int")

    out = out.withColumns({"mix_first": words(at), "mix_again": words(at + F.col("mix_source_size")),
                           "mix_shard_first": shard_of(at), "mix_shard_again": shard_of(at + F.col("mix_source_size")),
                           "mix_order": F.md5(F.concat(F.col("mix_place"), F.lit("/"), F.col("mix_tie")))})
    out = out.withColumn("mix_taken", F.col("mix_first") + F.col("mix_again"))
    keep = ["size", "source_size", "target", "taken", "first", "again", "shard_first", "shard_again", "order"]
    return out.select(*[F.col(h).alias(c) for c, h in names.items()],
                      *[F.col(f"mix_{k}").alias(prefix + k) for k in keep])


def materialise(assigned: DataFrame, text_col: str = "text", whole: bool = False, shards: int = 8) -> DataFrame:
    """The mixed rows of ``assign``: each document once per pass that takes words of
    it, with shard and order under its prefix; dealt to partitions by ranges of both, so
    that a partition holds one of the ``shards`` only, and shuffled there. The text of a cut document is its first words or, if
    ``whole``, all of it: a first pass then ends with the whole document its run
    ends in, and a second pass takes that document again if more than half of it
    lies in the run. A source then has less than one document more than its run,
    or half a document less in its second pass."""
    prefix = assigned.columns[-1][:-len("order")]
    added = {c: f"mix_{c[len(prefix):]}" for c in assigned.columns if c.startswith(prefix)}
    own = {c: f"__c{i}" for i, c in enumerate(c for c in assigned.columns if c not in added)}
    text_col = own[text_col]
    assigned = assigned.select(*[F.col(f"`{c}`").alias(h) for c, h in {**own, **added}.items()])
    passes = F.array(F.struct(F.col("mix_first").alias("n"), F.col("mix_shard_first").alias("s"), F.lit(0).alias("p")),
                     F.struct(F.col("mix_again").alias("n"), F.col("mix_shard_again").alias("s"), F.lit(1).alias("p")))
    # a document without words is taken once
    ok = lambda x: (x["n"] > 0) | ((F.col("mix_size") == 0) & (x["p"] == 0))
    if whole:
        ok = lambda x: (x["p"] == 0) & ((x["n"] > 0) | (F.col("mix_size") == 0)) | (2 * x["n"] > F.col("mix_size"))
    out = assigned.withColumn("mix_pass", F.explode(F.filter(passes, ok)))
    n = F.col("mix_pass")["n"]
    text = F.col(f"`{text_col}`")
    cut = text if whole else F.array_join(F.slice(F.split(F.ltrim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")), " "),
                               F.lit(1), F.greatest(n, F.lit(1)).cast("int")), " ")
    out = out.withColumn(text_col, F.when(n >= F.col("mix_size"), text).otherwise(cut))
    out = out.withColumns({"mix_shard": F.col("mix_pass")["s"],
                           "mix_order": F.md5(F.concat(F.col("mix_order"), F.col("mix_pass")["p"].cast("string")))})
    out = out.select(*own.values(), "mix_shard", "mix_order")
    # orders are md5 sums: equal ranges of their first digits hold about as many rows
    per = max(1, math.ceil(int(out.sparkSession.conf.get("spark.sql.shuffle.partitions")) / shards))
    first = F.conv(F.substring("mix_order", 1, 6), 16, 10).cast("long")
    part = F.col("mix_shard") * F.lit(per) + F.floor(first * F.lit(per) / F.lit(16 ** 6))
    out = out.repartitionById(shards * per, part.cast("int")).sortWithinPartitions("mix_shard", "mix_order")
    return out.toDF(*own, prefix + "shard", prefix + "order")

