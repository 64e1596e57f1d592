"""Min-max scaling (O7) with Spark ML stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import MinMaxScaler, MinMaxScalerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_minmax(df: DataFrame, input_col: str = "features",
               output: str = "scaledFeatures") -> MinMaxScalerModel:
    """Per-feature min/max in one distributed pass; a constant feature maps to 0.5."""
    return MinMaxScaler(inputCol=input_col, outputCol=output, min=0.0, max=1.0).fit(df)


def unpack(df: DataFrame, vector_col: str, names: Sequence[str], keep: Sequence[str] = (),
           digits: int | None = None) -> DataFrame:
    """Vector column -> one double column per element."""
    arr = vector_to_array(F.col(vector_col))
    cols = [arr[i] if digits is None else F.round(arr[i], digits) for i in range(len(names))]
    return df.select(*keep, *[c.alias(n) for c, n in zip(cols, names)])
