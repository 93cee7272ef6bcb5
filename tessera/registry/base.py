"""Query/oracle registration helpers."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_MODULES = ("profile_q", "io_q", "prep_q", "linalg_q", "funcs_q", "model_q", "train_q")


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with an optional oracle."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def tbl(spark: SparkSession, sf_dir: str, name: str, cols: list[str] | None = None) -> DataFrame:
    return read_table(spark, sf_dir, name, cols)


def R(expr: str) -> str:
    """SQL: round half away from zero to 4 decimals, -0.0 folded to 0.0."""
    return f"(CASE WHEN round(CAST({expr} AS DOUBLE), 4) = 0 THEN 0.0 ELSE round(CAST({expr} AS DOUBLE), 4) END)"


def R6(expr: str) -> str:
    """SQL: round half away from zero to 6 decimals (gradients, parameters)."""
    return (f"(CASE WHEN round(CAST({expr} AS DOUBLE), 6) = 0 THEN 0.0 "
            f"ELSE round(CAST({expr} AS DOUBLE), 6) END)")


def r6(c):
    from tessera.functions.numeric import round_half_away
    return round_half_away(c, 6)


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(f"tessera.registry.{m}")
