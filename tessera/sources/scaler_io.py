"""Scaler persistence (S5): the statistics table as Parquet."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tessera.operators.scale import Scaler


def save_scaler(spark: SparkSession, scaler: Scaler, path: str) -> None:
    scaler.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(path)


def load_scaler(spark: SparkSession, path: str, kind: str | None = None) -> Scaler:
    """Read a saved scaler; ``kind`` (if given) must match the stored type."""
    rows = spark.read.parquet(path).collect()   # one row per feature
    sc = Scaler.from_rows(rows)
    if kind is not None and sc.kind != kind:
        raise ValueError(f"scaler file holds a {sc.kind} scaler, not {kind}")
    return sc
