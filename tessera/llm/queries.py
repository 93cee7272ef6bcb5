"""The registered queries of the operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import conversations, licences, line_dedup, mixing, packing, records, resample, rules, sharding
from tessera.llm import shingle_join, token_counts, topk, vector_dedup
from tessera.llm.common import table
from tessera.llm.oracles import ORACLES  # noqa: F401
from tessera.session import scratch_path

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents", "doc_id", "text"),
                                     public_tokenizers.path("word_bpe_49k.json"), limit=2048)


@query
def op2_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = shingle_join.join(table(spark, sf_dir, "documents", "doc_id", "text"), percent=75, length=5)
    return joined.select("doc_id", "n_shingles", "component_id")


@query
def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.drop("places")


@query
def op4_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), cosine=0.95)


@query
def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), k=20, scale=64, every=20)


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents", "doc_id", "text"), [1.0] * 8)


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"),
                                  public_tokenizers.path("byte_bpe_50k.json"), end_id=0,
                                  max_tokens=1024, max_segments=32, max_loss=1024)


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.assign(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", *[F.col(f"mix_{c}").alias(c) for c in ("size", "source_size", "target", "taken")],
                        "mix_shard_first", "mix_shard_again")


@query
def op9_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "records")
    files = records.write_records(table(spark, sf_dir, "documents", "doc_id", "text"),
                                  public_tokenizers.path("byte_bpe_50k.json"), folder, end_id=2)
    return records.read_records(spark, files, folder)


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = rules.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return rules.apply(docs, model).select("doc_id", rules.held_out(F.col("doc_id")).alias("held_out"),
                                           "score", "predicted")


@query
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resample.resample(table(spark, sf_dir, "documents", "doc_id", "text"),
                             table(spark, sf_dir, "benchmark", "text"),
                             most=2, buckets=10_000, min_words=20, percent=25, seed=7)
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return conversations.repair(conversations.damage(turns))


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = line_dedup.LineIndex(spark, min_docs=3, min_chars=20)
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    index.insert(docs)
    return index.dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
