"""Model persistence (S6): two Parquet tables under one folder.

``layers``: (layer INT, kind STRING, config STRING json) plus a row -1 with
the input shape; ``params``: (layer INT, param STRING, idx BIGINT, v DOUBLE).
Both are model-sized; optimizer state is not saved.
"""

from __future__ import annotations

import json
from dataclasses import asdict

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

from tessera.operators.model import LAYER_TYPES, Sequential

FORMAT = "tessera-sequential-v1"


def save_model(spark: SparkSession, model: Sequential, path: str) -> None:
    rows = [(-1, FORMAT, json.dumps({"input_shape": list(model.input_shape)}))]
    for i, layer in enumerate(model.layers):
        cfg = asdict(layer)
        rows.append((i, cfg.pop("kind"), json.dumps(cfg)))
    spark.createDataFrame(rows, "layer int, kind string, config string") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/layers")
    frames = []
    for li, p in enumerate(model.params):
        for k in ("w", "b"):
            if k in p:
                v = np.asarray(p[k], dtype=float).ravel()
                frames.append(pd.DataFrame({"layer": np.full(v.size, li, dtype=np.int32), "param": k,
                                            "idx": np.arange(v.size, dtype=np.int64), "v": v}))
    pdf = pd.concat(frames, ignore_index=True) if frames else \
        pd.DataFrame({"layer": [], "param": [], "idx": [], "v": []})
    # Arrow transfer of a model-sized table
    spark.createDataFrame(pdf, "layer int, param string, idx long, v double") \
        .write.mode("overwrite").parquet(f"{path}/params")


def load_model(spark: SparkSession, path: str) -> Sequential:
    layer_rows = sorted(spark.read.parquet(f"{path}/layers").collect(), key=lambda r: r["layer"])
    if not layer_rows or layer_rows[0]["layer"] != -1 or layer_rows[0]["kind"] != FORMAT:
        raise ValueError(f"{path} is not a saved model")
    meta = json.loads(layer_rows[0]["config"])
    layers = []
    for r in layer_rows[1:]:
        cfg = json.loads(r["config"])
        for k in ("kernel", "stride", "padding", "pool"):
            if k in cfg:
                cfg[k] = tuple(cfg[k])
        layers.append(LAYER_TYPES[r["kind"]](**cfg))
    model = Sequential(tuple(meta["input_shape"]), layers, seed=0)
    params = [{k: np.array(v, dtype=float) for k, v in p.items()} for p in model.params]
    t = spark.read.parquet(f"{path}/params").toArrow()            # model-sized
    layer, param = t.column("layer").to_numpy(), np.array(t.column("param").to_pylist())
    idx, val = t.column("idx").to_numpy(), t.column("v").to_numpy()
    for li, p in enumerate(params):
        for k in p:
            sel = (layer == li) & (param == k)
            p[k].reshape(-1)[idx[sel]] = val[sel]
    model.params = params
    return model
