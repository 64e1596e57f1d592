"""What a saved model was fitted on (S7, S8): kept beside it and checked when it is loaded.

A model's numbers mean something only for the features that it was fitted on, in
their order, and for the labels in theirs.  The manifest holds them with the
parameters, the bounds and the types of the input, as one JSON text.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


class ModelMismatch(ValueError):
    """A saved model does not fit what is asked of it; the message names the columns or values."""


@dataclass(frozen=True)
class ModelManifest:
    module: str
    features: list[str]                    # in the order of the model's vector
    feature_types: dict[str, str]          # of the view
    input_types: dict[str, str]            # of the table that the view was built from
    labels: list[str]                      # in the order of the model's classes
    parameters: dict = field(default_factory=dict)
    bounds: dict = field(default_factory=dict)      # column -> [center, lower, upper]

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self), sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "ModelManifest":
        try:
            return ModelManifest(**json.loads(spark.read.text(path).first()[0]))
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                raise ModelMismatch(f"{path}: the model has no manifest; train it again") from e
            raise

    def check_features(self, features: Sequence[str]) -> None:
        """The view still has the model's features, in their order."""
        gone, new = [c for c in self.features if c not in features], [c for c in features if c not in self.features]
        if gone or new:
            raise ModelMismatch(f"{self.module}: the view no longer has {gone} and has {new} that the model was not fitted on")
        if list(features) != self.features:
            moved = [c for c, d in zip(self.features, features, strict=True) if c != d]
            raise ModelMismatch(f"{self.module}: the view has {moved} in another order than the model")

    def check_labels(self, labels: Sequence[str]) -> None:
        if list(labels) != self.labels:
            raise ModelMismatch(f"{self.module}: the model's labels are {list(labels)}, its manifest's {self.labels}")

    def check_bounds(self, bounds: Mapping[str, Sequence[float | None]]) -> None:
        other = sorted(c for c in {*bounds, *self.bounds} if list(bounds.get(c, ())) != list(self.bounds.get(c, ())))
        if other:
            raise ModelMismatch(f"{self.module}: the saved bounds of {other} are not those of the fit")

    def check_types(self, types: Mapping[str, str]) -> None:
        """The columns to predict from have the types that the model was fitted on."""
        known = {c: t for c, t in self.feature_types.items() if c in types}
        other = {c: f"{types[c]} for {t}" for c, t in known.items() if types[c] != t}
        if other:
            raise ModelMismatch(f"{self.module}: columns of other types than at the fit: {other}")
