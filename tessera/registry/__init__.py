"""Registered queries: each has a Spark side (``(spark, sf_dir) -> DataFrame``)
and, where SQL can express it, a DuckDB oracle over the same parquet tables.

Results use scalar columns (arrays are exploded with their position) and
doubles rounded half away from zero to 4 decimals on both sides.
"""

from tessera.registry.base import QUERIES, ORACLES, load_all

__all__ = ["QUERIES", "ORACLES", "load_all"]
