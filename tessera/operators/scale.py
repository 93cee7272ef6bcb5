"""Standard and min-max scalers (P7-P10) for wide columns and array columns.

Fit: one aggregate. For array features (matrices flattened per row, images in
channel-row-col order) the array is ``posexplode``-d and grouped by position;
partial aggregation keeps the shuffle at one row per (task, position).
Transform: a projection with the statistics as literals (bounded by the number
of features) - no join, no shuffle. Zero deviation / zero range gives NULL
(``try_divide``), never an error or Inf.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.numeric import double_array_lit

KINDS = ("standard", "minmax")


@dataclass
class Scaler:
    kind: str                      # "standard" or "minmax"
    features: list[str]            # column names, or ["0", "1", ...] for arrays
    a: list[float | None]          # mean or min
    b: list[float | None]          # sample deviation or max

    def _scale(self, x, i):
        a, b = F.lit(self.a[i]).cast("double"), F.lit(self.b[i]).cast("double")
        if self.kind == "standard":
            return F.try_divide(x - a, b)
        return F.try_divide(x - a, b - a)

    def transform(self, df: DataFrame, cols: list[str] | None = None) -> DataFrame:
        cols = cols or self.features
        idx = {c: i for i, c in enumerate(cols)}
        return df.select(*[self._scale(F.col(c).cast("double"), idx[c]).alias(c) if c in idx else F.col(c)
                           for c in df.columns])

    def transform_array(self, df: DataFrame, col: str = "x") -> DataFrame:
        a = _stat_array(self.a)
        b = _stat_array(self.b)
        stats = F.arrays_zip(a.alias("a"), b.alias("b"))
        if self.kind == "standard":
            fn = lambda v, s: F.try_divide(v - s["a"], s["b"])
        else:
            fn = lambda v, s: F.try_divide(v - s["a"], s["b"] - s["a"])
        return df.withColumn(col, F.zip_with(F.col(col).cast("array<double>"), stats, fn))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(self.kind, i, f, self.a[i], self.b[i]) for i, f in enumerate(self.features)]
        return spark.createDataFrame(rows, "scaler string, idx int, feature string, a double, b double")

    @staticmethod
    def from_rows(rows) -> "Scaler":
        rows = sorted(rows, key=lambda r: r["idx"])
        kinds = {r["scaler"] for r in rows}
        if len(kinds) != 1:
            raise ValueError("scaler table must hold exactly one scaler kind")
        return Scaler(kinds.pop(), [r["feature"] for r in rows], [r["a"] for r in rows],
                      [r["b"] for r in rows])


def _stat_array(vals):
    """Literal statistics array; NULL statistics (empty column) stay NULL."""
    if any(v is None for v in vals):
        return F.array(*[F.lit(v).cast("double") for v in vals])
    return double_array_lit(vals)


def _ab(kind: str, x):
    if kind == "standard":
        return F.avg(x), F.stddev_samp(x)
    return F.min(x), F.max(x)


def fit_scaler(df: DataFrame, cols: list[str], kind: str = "standard") -> Scaler:
    if kind not in KINDS:
        raise ValueError(f"unknown scaler {kind!r}")
    aggs = []
    for i, c in enumerate(cols):
        a, b = _ab(kind, F.col(c).cast("double"))
        aggs += [a.alias(f"a{i}"), b.alias(f"b{i}")]
    r = df.agg(*aggs).collect()[0]
    return Scaler(kind, list(cols), [r[f"a{i}"] for i in range(len(cols))],
                  [r[f"b{i}"] for i in range(len(cols))])


def fit_scaler_array(df: DataFrame, col: str = "x", kind: str = "standard") -> Scaler:
    """Per-position statistics of an array column (all rows same length)."""
    if kind not in KINDS:
        raise ValueError(f"unknown scaler {kind!r}")
    long = df.select(F.posexplode(F.col(col).cast("array<double>")).alias("pos", "v"))
    a, b = _ab(kind, F.col("v"))
    rows = sorted(long.groupBy("pos").agg(a.alias("a"), b.alias("b")).collect())
    return Scaler(kind, [str(r["pos"]) for r in rows], [r["a"] for r in rows], [r["b"] for r in rows])
