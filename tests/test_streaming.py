"""Fitted transforms and scoring applied to a file stream of the shared tables."""

import uuid

import pytest
from pyspark.sql import functions as F

from tessera.operators import encode
from tessera.operators.impute import fit_imputer
from tessera.operators.scale import fit_scaler
from tessera.operators.score import predict
from tessera.registry.model_q import mlp
from tessera.streaming.apply import prepare_stream, score_stream

from conftest import SF_SMALL


def _drain(query_df, name):
    q = query_df.writeStream.format("memory").queryName(name).outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def test_stream_prepare_matches_batch(spark):
    path = f"{SF_SMALL}/events.parquet"
    batch = spark.read.parquet(path).select("event_id", "event_type", "value")
    imp = fit_imputer(batch, ["value"], "mean", strings=["event_type"])
    sc = fit_scaler(imp.transform(batch), ["value"], "standard")
    key = encode.category_key(F.col("event_type"))
    dic = encode.fit_dictionary(batch, key, "event_id")
    stream = (spark.readStream.schema(spark.read.parquet(path).schema)
              .option("maxFilesPerTrigger", 1).option("pathGlobFilter", "events.parquet").parquet(SF_SMALL).select("event_id", "event_type", "value"))
    name = f"prep_{uuid.uuid4().hex[:8]}"
    _drain(prepare_stream(stream, imp, sc, {"code": (key, dic)}), name)
    got = {r["event_id"]: (round(r["value"], 9), r["code"]) for r in spark.table(name).collect()}
    exp = {r["event_id"]: (round(r["value"], 9), r["code"]) for r in
           prepare_stream(batch, imp, sc, {"code": (key, dic)}).collect()}
    assert got == exp and len(got) == batch.count()


def test_stream_scoring_matches_batch(spark):
    path = f"{SF_SMALL}/embeddings.parquet"
    schema = spark.read.parquet(path).schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "embeddings.parquet").parquet(SF_SMALL) \
        .select(F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("x"))
    name = f"score_{uuid.uuid4().hex[:8]}"
    _drain(score_stream(rows, mlp()), name)
    got = {r["row_id"]: r["y_pred"] for r in spark.table(name).collect()}
    batch = spark.read.parquet(path).select(F.col("vec_id").alias("row_id"),
                                            F.col("embedding").cast("array<double>").alias("x"))
    exp = {r["row_id"]: r["y_pred"] for r in predict(batch, mlp()).collect()}
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k])
