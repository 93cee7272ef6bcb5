"""Previews in row order (S4): the first n rows, the last n, or all.

``orderBy(key).limit(n)`` plans as TakeOrderedAndProject: every task keeps its
own n smallest (or largest) rows and only n rows per task reach the final merge,
so the preview never sorts the table. ``n < 0`` means all rows (a distributed sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType

from tessera.plans.positions import positions_by_key


def fmt2(c) -> "F.Column":
    """``%.2f`` text with NULL shown as ``nan`` (format_string would print 'nu')."""
    return F.when(c.isNull(), F.lit("nan")).otherwise(F.format_string("%.2f", c.cast("double")))


def preview(df: DataFrame, n: int = 10, key: str = "row_id", end: str = "first") -> DataFrame:
    """First (or with ``end="last"`` last) ``n`` rows by ``key`` with their 1-based
    ``row_no`` in the whole table; numeric columns as ``%.2f`` strings, missing
    values as ``nan``. NULL keys come first."""
    if end not in ("first", "last"):
        raise ValueError(f"end is first or last, not {end}")
    order = F.col(key).asc_nulls_first() if end == "first" else F.col(key).desc_nulls_last()
    src = df.orderBy(order).limit(n) if n >= 0 else df
    num = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    arr = {f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)}
    cols = [F.col(key)]
    for c in df.columns:
        if c == key:
            continue
        if c in num:
            e = fmt2(F.col(c))
        elif c in arr:   # dataset vectors: every element as %.2f, space separated
            e = F.array_join(F.transform(F.col(c), lambda v: fmt2(v)), " ")
        else:
            e = F.coalesce(F.col(c), F.lit("nan"))
        cols.append(e.alias(c))
    out = src.select(*cols)
    if n >= 0:
        # at most n rows: numbering them with one window is bounded
        place = F.row_number().over(Window.orderBy(order)).cast("long")
        return out.withColumn("row_no", place if end == "first" else F.lit(df.count() + 1) - place)
    pos = positions_by_key(out, key, "_pos")
    return pos.withColumn("row_no", F.col("_pos") + 1).drop("_pos")
