"""Tables to labelled datasets.

A dataset is ``(row_id, x ARRAY<DOUBLE>, y ARRAY<DOUBLE>)`` plus metadata:
feature names, image shape ``(channels, rows, cols)`` and the class count.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.encode import (Dictionary, category_key, fit_dictionaries, fit_dictionary,
                                      label_encode, numeric_key, one_hot)


@dataclass
class Dataset:
    df: DataFrame                      # row_id, x, y
    features: list[str]
    shape: tuple[int, ...] | None = None
    classes: int | None = None
    dictionaries: dict[str, Dictionary] = field(default_factory=dict)

    @property
    def x(self) -> DataFrame:
        return self.df.select("row_id", "x")

    @property
    def y(self) -> DataFrame:
        return self.df.select("row_id", "y")

    def count(self) -> int:
        return self.df.count()


def to_dataset(df: DataFrame, target: str | int, numeric: list[str], strings: list[str],
               key: str = "row_id", task: str = "classification") -> Dataset:
    """x = numeric columns in table order, then label-encoded string columns,
    without the target; y = one-hot target (classification, codes in first
    appearance order) or the raw numeric target (regression)."""
    cols = [c for c in df.columns if c in numeric or c in strings]
    if isinstance(target, int):
        target = cols[target]
    if target not in cols:
        raise ValueError(f"unknown target column {target!r}")
    if task not in ("classification", "regression"):
        raise ValueError("task must be classification or regression")
    x_num = [c for c in cols if c in numeric and c != target]
    x_str = [c for c in cols if c in strings and c != target]
    cur = df
    tkey = None
    if task == "classification":
        tkey = numeric_key(F.col(target), df.schema[target].dataType.simpleString()) if target in numeric else category_key(F.col(target))
    wanted = {c: category_key(F.col(c)) for c in x_str}
    if tkey is not None:
        wanted["_target"] = tkey
    dicts: dict[str, Dictionary] = fit_dictionaries(df, wanted, key) if wanted else {}
    for c in x_str:
        cur = label_encode(cur, category_key(F.col(c)), dicts[c], f"_code_{c}")
    x = F.array(*[F.col(c).cast("double") for c in x_num],
                *[F.col(f"_code_{c}").cast("double") for c in x_str])
    classes = None
    if task == "regression":
        if target not in numeric:
            raise ValueError("regression needs a numeric target")
        y = F.array(F.col(target).cast("double"))
    else:
        dicts[target] = dicts.pop("_target")
        cur = label_encode(cur, tkey, dicts[target], "_code_target")
        classes = dicts[target].size
        y = one_hot(F.col("_code_target"), classes)
    out = cur.select(F.col(key).alias("row_id"), x.alias("x"), y.alias("y"))
    return Dataset(out, x_num + x_str, None, classes, dicts)


def image_permutation(channels: int, rows: int, cols: int) -> list[int]:
    """Source index of every channel-row-col output position for pixels
    stored interleaved (pixel (k, h) of channel j at j + channels*(k*cols + h))."""
    return [j + channels * (k * cols + h)
            for j in range(channels) for k in range(rows) for h in range(cols)]


def reorder_pixels(x, channels: int, rows: int, cols: int):
    """Interleaved pixel array -> channel-row-col array (constant permutation)."""
    perm = image_permutation(channels, rows, cols)
    idx = F.expr("array(" + ", ".join(str(p + 1) for p in perm) + ")")   # one literal, 1-based
    return F.transform(idx, lambda p: F.element_at(x, p))


def to_image_dataset(df: DataFrame, pixels: str | list[str], label: str, shape: tuple[int, int, int],
                     key: str = "row_id") -> Dataset:
    """``pixels`` (an array column or the ordered pixel columns) in interleaved
    order -> x in channel-row-col order; y = one-hot of the numeric label."""
    c, h, w = shape
    arr = F.col(pixels).cast("array<double>") if isinstance(pixels, str) else \
        F.array(*[F.col(p).cast("double") for p in pixels])
    size = c * h * w
    src = df.withColumn("_px", arr)
    bad = src.where(F.size("_px") != size).limit(1).count()
    if bad:
        raise ValueError(f"image rows must have {size} pixels")
    dic = fit_dictionary(df, numeric_key(F.col(label), df.schema[label].dataType.simpleString()), key)
    enc = label_encode(src, numeric_key(F.col(label), df.schema[label].dataType.simpleString()), dic, "_code")
    out = enc.select(F.col(key).alias("row_id"), reorder_pixels(F.col("_px"), c, h, w).alias("x"),
                     one_hot(F.col("_code"), dic.size).alias("y"))
    return Dataset(out, [str(i) for i in range(size)], (c, h, w), dic.size, {label: dic})


def split_dataset(ds: Dataset, test_size: float, seed: int) -> tuple[Dataset, Dataset]:
    """(train, test) datasets with exactly ``round(test_size * n)`` test rows
    (first rows of the seeded permutation of ``row_id``); metadata is kept."""
    from tessera.operators.split import train_test_split
    train, test = train_test_split(ds.df, "row_id", test_size, seed)
    return (Dataset(train, ds.features, ds.shape, ds.classes, ds.dictionaries),
            Dataset(test, ds.features, ds.shape, ds.classes, ds.dictionaries))
