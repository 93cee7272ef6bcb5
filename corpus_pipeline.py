"""From raw documents to packed token sequences, in four stages.

Each stage gets what its predecessor kept, as a table read back from the shared
folder, and calls one operator of ``tessera.llm``; all but the last return the
columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import mixing, packing, rules, shingle_join
from tessera.llm.common import table
from tessera.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble rejects go. A null text is scored as the
    empty one; rows equal in all columns go or stay together; no documents or
    labels give no rules, and rows stay; all columns are as they were."""
    model = rules.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return rules.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five words, 0.75): the
    one with the smallest id, null last, and one of rows equal in id and text.
    Texts without words all stay; all columns are as they were."""
    return shingle_join.keep_one(docs, percent=75, length=5)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document stands, whole, as often as it is
    taken. Null sources are one source; a text without words is taken once; other
    columns are as they were, whatever their names."""
    return mixing.materialise(mixing.assign(docs), whole=True).select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens. A null or empty text is its end id; rows
    are packed one by one, equal ones too; no documents give no sequences. Workers
    still hold what the stages before left, so slices and caches are smaller here."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0,
                                  max_tokens=1024, max_segments=32, max_loss=1024,
                                  slice_bytes=4 << 20, cache_bytes=32 << 20)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("mixture", mixture), ("pack", pack)]

# A fitted model, hashes and a tokenizer: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
