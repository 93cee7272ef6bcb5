"""Fitted preparation and scoring on streaming DataFrames.

Every fitted transform in this package is a stateless projection (imputer,
scalers), a stream-static lookup join (label / one-hot encoders against a
checkpointed dictionary) or a narrow ``mapInArrow`` (model scoring). None of
them keeps streaming state, so they apply to each micro-batch unchanged and
scale with the stream's partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.encode import Dictionary, label_encode, one_hot
from tessera.operators.impute import Imputer
from tessera.operators.model import Sequential
from tessera.operators.scale import Scaler
from tessera.operators.score import predict


def prepare_stream(stream: DataFrame, imputer: Imputer | None = None,
                   scaler: Scaler | None = None,
                   encoders: dict[str, tuple[Column, Dictionary]] | None = None,
                   one_hot_cols: tuple[str, ...] = ()) -> DataFrame:
    """Impute, scale and encode a stream with transforms fitted on batch data.

    ``encoders`` maps an output column to ``(value expression, dictionary)``;
    names listed in ``one_hot_cols`` become one-hot arrays instead of codes.
    """
    out = stream
    if imputer is not None:
        out = imputer.transform(out)
    if scaler is not None:
        out = scaler.transform(out)
    for name, (value, dic) in (encoders or {}).items():
        out = label_encode(out, value, dic, name)
        if name in one_hot_cols:
            out = out.withColumn(name, one_hot(F.col(name), dic.size))
    return out


def score_stream(stream: DataFrame, model: Sequential, key: str = "row_id", x: str = "x",
                 keep: list[str] | None = None) -> DataFrame:
    """Append model outputs (``y_pred``) to every streamed row."""
    return predict(stream, model, key=key, x=x, keep=keep)
