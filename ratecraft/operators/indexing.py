"""Label indexing (A5, M3, M4) with Spark ML's StringIndexer / IndexToString.

The indexer is fitted once and the *fitted* model is reused everywhere its
labels are needed (pipeline stage, back-conversion, locating the good class),
so the index order can never disagree between two fits.
"""

from __future__ import annotations

from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_label_indexer(df: DataFrame, label: str = "label",
                      output: str = "index_label") -> StringIndexerModel:
    """Index 0 = most frequent label; ties alphabetical (frequencyDesc)."""
    return StringIndexer(inputCol=label, outputCol=output,
                         stringOrderType="frequencyDesc", handleInvalid="error").fit(df)


def label_index_table(df: DataFrame, label: str = "label") -> DataFrame:
    """(label text, index_label, n): the fitted order with per-label counts."""
    model = fit_label_indexer(df, label)
    return (model.transform(df.select(label))
            .groupBy(F.col(label).cast("string").alias("label"), "index_label")
            .agg(F.count(F.lit(1)).alias("n")))


def index_to_label(model: StringIndexerModel, df: DataFrame, index_col: str = "prediction",
                   output: str = "predictedLabel") -> DataFrame:
    """M4: index -> original label text, with the labels of ``model``."""
    return IndexToString(inputCol=index_col, outputCol=output, labels=model.labels).transform(df)


def label_position(model: StringIndexerModel, value: float) -> int:
    """Index of a label value (e.g. the good label 1.0) in the fitted order."""
    text = str(float(value))
    labels = list(model.labels)
    if text not in labels:
        raise ValueError(f"label {text!r} not among fitted labels {labels}")
    return labels.index(text)
