"""The registered queries and the pipeline on the smallest tables."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import rules, shingle_join
from tessera.llm.queries import QUERIES

from llm_fixtures import SF, shipped  # noqa: F401


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_its_table(spark, name):
    rows = QUERIES[name](spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    ids = {r[0] for r in rows.select(rows.columns[0]).collect()}
    if name.startswith("op5"):
        assert all(i % 20 == 0 for i in ids) and rows.count() == 20 * len(ids)
    elif name.startswith("op4"):
        assert len(ids) == spark.read.parquet(f"{SF}/embeddings.parquet").count() == rows.count()
    elif name.startswith("op12"):
        turns = spark.read.parquet(f"{SF}/conversations.parquet")
        assert len(ids) == turns.select("conv_id").distinct().count() == rows.count()
    else:
        assert len(ids) == n


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out, seen = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, seen, SF)
        seen = spark.createDataFrame(df.collect(), df.schema)
        out[name] = seen
    for name in ("quality", "near_duplicates", "mixture"):
        assert out[name].columns == docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = labels.where("quality = 1").join(docs, "doc_id").count()
    kept = labels.where("quality = 1").join(out["quality"], "doc_id").count()
    assert kept >= 0.97 * good
    left = shingle_join.join(out["near_duplicates"]).where("n_shingles > 0")
    assert left.where("doc_id != component_id").count() == 0
    assert {r.doc_id for r in out["mixture"].collect()} <= {r.doc_id for r in out["near_duplicates"].collect()}
    tokens = defaultdict(int)
    for r in out["pack"].collect():
        tokens[r.sequence_id] += r.length
    assert max(tokens.values()) <= 1024
    assert {r.doc_id for r in out["pack"].collect()} == {r.doc_id for r in out["mixture"].collect()}


CLASHES = ["score", "predicted", "mix_size", "mix_order", "mix_pass", "__text", "__id", "__c0", "own_id", "keep_text",
           "n", "th", "sig", "component", "size", "words", "shard"]


@pytest.mark.parametrize("stage", [0, 1, 2])
def test_stages_keep_clashing_columns(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    docs = docs.selectExpr("*", *[f"concat('{c} ', doc_id) AS `{c}`" for c in CLASHES])
    out = corpus_pipeline.STAGES[stage][1](spark, docs, SF)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[c] == f"{c} {r.doc_id}" for r in rows for c in CLASHES)


def test_stages_on_awkward_and_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    none = docs.limit(0)
    rows = [(None, None, None, None, None), (5, None, "x", None, 0), (5, "", "x", "s", 0), (6, " \n", None, "s", 2),
            (7, "w " * 30_000, "x", "s", 9), (7, "w " * 30_000, "x", "s", 9), (8, "one", "x", "t", 3)]
    odd = spark.createDataFrame(rows, docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).collect() == []
        assert stage(spark, odd, SF).count() > 0
    assert len(corpus_pipeline.near_duplicates(spark, odd, SF).collect()) == 6


def test_run_writes_and_rereads(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and "sequence_id" in rows.columns
    assert rules.MAX_ROWS and rows.agg(F.max("length")).first()[0] <= 1024
