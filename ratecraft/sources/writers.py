"""Sinks and sources of scores and fitted models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ratecraft.session import scratch_path
from ratecraft.sources.schemas import score_schema
from ratecraft.sources.score_tables import ScoreTable


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and scan that: what follows
    reads pruned columns, and a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_scores(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Parquet score sink.  Default refuses an existing path (raises),
    ``mode="overwrite"`` replaces it."""
    df.write.mode(mode).parquet(path)
    return path


def read_scores(spark: SparkSession, path: str, score_col: str) -> DataFrame:
    """Parquet score source with the fixed two-column schema."""
    return spark.read.schema(score_schema(score_col)).parquet(path)


@dataclass(frozen=True)
class ModelStore:
    """``<base>/<module>/{model,manifest,bounds,predict}``.

    ``base`` must be a cluster-shared folder (e.g. below ``spark.checkpoint.dir``)."""

    base: str

    def module_dir(self, module: str) -> str:
        return f"{self.base.rstrip('/')}/{module}"

    def model_path(self, module: str) -> str:
        return f"{self.module_dir(module)}/model"

    def predict_path(self, module: str) -> str:
        return f"{self.module_dir(module)}/predict"

    def scores(self, module: str) -> ScoreTable:
        """The sub-score table of a module, replaced version by version."""
        return ScoreTable(self.predict_path(module))

    def bounds_path(self, module: str) -> str:
        return f"{self.module_dir(module)}/bounds"

    def manifest_path(self, module: str) -> str:
        return f"{self.module_dir(module)}/manifest"

    def save_model(self, module: str, model: PipelineModel) -> str:
        path = self.model_path(module)
        model.write().overwrite().save(path)
        return path

    def load_model(self, module: str) -> PipelineModel:
        return PipelineModel.load(self.model_path(module))
