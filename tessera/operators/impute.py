"""Simple imputer.

Fit is one aggregate for mean/constant, the exact distributed median of
``plans.quantile`` for median, and the two-level value count of
``profile.describe_string`` for the most frequent string. The fitted object is
one fill value per column (bounded by the column count); transform is a single
``coalesce`` projection, so it also applies to streaming DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.missing import number
from tessera.operators.profile import modes
from tessera.plans.quantile import column_stats, exact_medians

NUMERIC_STRATEGIES = ("mean", "median", "constant")
STRING_STRATEGIES = ("most_frequent", "constant")


@dataclass
class Imputer:
    fill: dict[str, object] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace NULLs and NaNs by the fitted values; a NULL fill leaves the column."""
        out = []
        for f in df.schema.fields:
            v = self.fill.get(f.name)
            c = F.col(f.name)
            if f.dataType.simpleString() in ("float", "double"):
                c = F.when(~F.isnan(c), c)
            out.append(F.coalesce(c, F.lit(v)).alias(f.name) if v is not None else F.col(f.name))
        return df.select(*out)


def fit_imputer(df: DataFrame, numeric: list[str] = (), strategy: str = "mean",
                fill_value: float | dict | None = None, strings: list[str] = (),
                string_strategy: str = "most_frequent",
                string_fill: str | dict | None = None, approx: bool = False,
                accuracy: int = 10_000) -> Imputer:
    """Fit fill values: mean / median (exact by default; ``approx=True`` uses
    one ``percentile_approx`` aggregate) / constant for numeric columns,
    most frequent / constant for string columns."""
    numeric, strings = list(numeric), list(strings)
    if strategy not in NUMERIC_STRATEGIES:
        raise ValueError(f"unknown imputer strategy {strategy!r}")
    if string_strategy not in STRING_STRATEGIES:
        raise ValueError(f"unknown string imputer strategy {string_strategy!r}")
    fill: dict[str, object] = {}
    if numeric:
        if strategy == "mean":
            r = df.agg(*[F.avg(number(c)).alias(c) for c in numeric]).collect()[0]
            fill.update({c: r[c] for c in numeric})
        elif strategy == "median" and approx:
            r = df.agg(*[F.percentile_approx(number(c), 0.5, accuracy).alias(c)
                         for c in numeric]).collect()[0]
            fill.update({c: (None if r[c] is None else float(r[c])) for c in numeric})
        elif strategy == "median":
            fill.update(exact_medians(df, numeric, column_stats(df, numeric)))
        else:
            fill.update({c: (fill_value.get(c) if isinstance(fill_value, dict) else fill_value)
                         for c in numeric})
            fill = {c: (None if v is None else float(v)) for c, v in fill.items()}
    if strings:
        if string_strategy == "most_frequent":
            fill.update(modes(df, strings))
        else:
            fill.update({c: (string_fill.get(c) if isinstance(string_fill, dict) else string_fill)
                         for c in strings})
    return Imputer(fill)
