"""Model specs and pipelines.

Classification pipeline (one per module):
  VectorAssembler(features) -> MinMaxScaler -> fitted StringIndexerModel
  (label -> index_label) -> tree ensemble -> IndexToString(prediction ->
  predictedLabel, labels of that same fitted indexer).

Training layout is fixed before fitting (``repartition(n, key)`` +
``sortWithinPartitions(key)``, n from the row count) so a seeded forest gives the
same trees whatever layout the input had.  The training frame is persisted around the
fit (the assembler/scaler/indexer/tree fits each read it) and released after.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.feature import IndexToString, MinMaxScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.functions.expressions import score_from_probability, vector_element
from ratecraft.operators.indexing import fit_label_indexer, label_position
from ratecraft.plans import forests

KEY = "uid_uid"
GOOD_LABEL = 1.0


@dataclass(frozen=True)
class ModelSpec:
    kind: str                 # rfc | gbtc | rfr | gbtr
    trees: int                # forest size or boosting iterations
    max_depth: int
    impurity: str | None = None
    scaled: bool = True
    score_mode: str = "probability"   # probability | label
    seed: int = 42
    rows_per_partition: int = 1_500   # of the training rows (see fixed_layout)
    partitions_enough: int | None = None       # from these on, partitions first fill to rows_full
    rows_full: int = 500_000
    max_memory_mb: int = 256
    checkpoint_interval: int = 10
    nodes_whole: int = 700_000        # a classifying forest that may have more nodes is fitted and kept in parts (forests.py)
    nodes_at_once: int = 60_000      # of its trees in one fit, about

    def small(self, trees: int, depth: int) -> "ModelSpec":
        return replace(self, trees=trees, max_depth=depth)


# ---- fixed values: the original model parameters -----------------------------
ENOUGH = 12                # partitions of a training frame (see fixed_layout)
FOREST_CLASSIFIER = ModelSpec("rfc", trees=30, max_depth=20, impurity="gini", partitions_enough=ENOUGH)
GBT_CLASSIFIER = ModelSpec("gbtc", trees=50, max_depth=10, score_mode="label", partitions_enough=ENOUGH)
FOREST_REGRESSOR = ModelSpec("rfr", trees=30, max_depth=10, impurity="variance", scaled=False, partitions_enough=ENOUGH)
GBT_REGRESSOR = ModelSpec("gbtr", trees=30, max_depth=15, partitions_enough=ENOUGH)
MODULE_MODELS = {
    "people": FOREST_CLASSIFIER,
    "consume": FOREST_CLASSIFIER,
    "finance": FOREST_CLASSIFIER,
    "relation": FOREST_CLASSIFIER,
    "interaction": GBT_CLASSIFIER,
}
# Small parameters for tests and the smoke entry.
SMALL_FOREST = (10, 5)
SMALL_GBT = (5, 4)
# ------------------------------------------------------------------------------


def small_spec(module: str) -> ModelSpec:
    spec = MODULE_MODELS[module]
    trees, depth = SMALL_GBT if spec.kind == "gbtc" else SMALL_FOREST
    return spec.small(trees, depth)


def _estimator(spec: ModelSpec, label_col: str, features_col: str, trees: int | None = None, seed: int | None = None):
    """``trees`` and ``seed``: of some trees of a classifying forest, each on as many features as in the whole forest."""
    spark_ckpt = {"cacheNodeIds": True, "checkpointInterval": spec.checkpoint_interval,
                  "maxMemoryInMB": spec.max_memory_mb}
    if spec.kind == "rfc":
        some = {} if trees is None else {"featureSubsetStrategy": "sqrt" if spec.trees > 1 else "all"}
        return RandomForestClassifier(labelCol=label_col, featuresCol=features_col, numTrees=trees or spec.trees,
                                      maxDepth=spec.max_depth, impurity=spec.impurity or "gini",
                                      seed=spec.seed if seed is None else seed, **some, **spark_ckpt)
    if spec.kind == "gbtc":
        return GBTClassifier(labelCol=label_col, featuresCol=features_col, maxIter=spec.trees,
                             maxDepth=spec.max_depth, seed=spec.seed, **spark_ckpt)
    if spec.kind == "rfr":
        return RandomForestRegressor(labelCol=label_col, featuresCol=features_col, numTrees=spec.trees,
                                     maxDepth=spec.max_depth, impurity=spec.impurity or "variance",
                                     seed=spec.seed, **spark_ckpt)
    if spec.kind == "gbtr":
        return GBTRegressor(labelCol=label_col, featuresCol=features_col, maxIter=spec.trees,
                            maxDepth=spec.max_depth, seed=spec.seed, **spark_ckpt)
    raise ValueError(f"unknown model kind {spec.kind!r}")


def fixed_layout(df: DataFrame, spec: ModelSpec, key: str = KEY) -> DataFrame:
    """A layout that depends only on the rows, not on how they arrived:
    hash-partitioned by key, sorted by key inside each partition.

    The number of partitions follows from the number of rows and the spec alone: the
    same rows and spec give the same trees under any session settings.  There is one
    partition per ``rows_per_partition`` rows.  A spec with ``partitions_enough`` stays
    at that many until each holds ``rows_full`` rows: every task of a level makes and
    shuffles the statistics of all nodes of the level, so work, shuffles and the number
    of small tasks grow with partitions x nodes, and deep trees of many rows have many
    nodes.  Counting reads only the columns that decide which rows there are."""
    n = df.count()
    partitions = max(1, -(-n // spec.rows_per_partition))
    if spec.partitions_enough is not None:
        partitions = min(partitions, max(spec.partitions_enough, -(-n // spec.rows_full)))
    return df.repartition(partitions, key).sortWithinPartitions(key)


def fit_classifier(train: DataFrame, features: Sequence[str], spec: ModelSpec,
                   label: str = "label") -> PipelineModel:
    """M2, M3, M4, M7/M8, M9 on a training frame with ``label`` (double).

    A forest of so many rows and trees that its nodes may not fit the driver is
    fitted some trees at a time and kept as a table (forests.py)."""
    laid = fixed_layout(train, spec)
    if spec.kind == "rfc" and not forests.whole(train.count(), spec.trees, spec.max_depth, spec.nodes_whole):
        with forests.turn():
            return _fit_in_parts(laid, features, spec, label)
    data = laid.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        indexer = fit_label_indexer(data, label, "index_label")
        feats = "scaledFeatures" if spec.scaled else "features"
        stages = [VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")]
        if spec.scaled:
            stages.append(MinMaxScaler(inputCol="features", outputCol="scaledFeatures", min=0.0, max=1.0))
        stages += [indexer, _estimator(spec, "index_label", feats),
                   IndexToString(inputCol="prediction", outputCol="predictedLabel",
                                 labels=indexer.labels)]
        return Pipeline(stages=stages).fit(data)
    finally:
        data.unpersist()


def _fit_in_parts(laid: DataFrame, features: Sequence[str], spec: ModelSpec, label: str) -> PipelineModel:
    data = laid.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        indexer = fit_label_indexer(data, label, "index_label")
        stages = [VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")]
        if spec.scaled:
            stages.append(MinMaxScaler(inputCol="features", outputCol="scaledFeatures", min=0.0, max=1.0))
        ready = Pipeline(stages=[*stages, indexer]).fit(data)
        grow = lambda trees, seed: _estimator(spec, "index_label", "scaledFeatures" if spec.scaled else "features", trees, seed)
        # two classes at least, as Spark's trees have
        forest = forests.fit_forest(ready.transform(data), grow, spec.trees, spec.seed, max(2, len(indexer.labels)), spec.nodes_at_once)
        return PipelineModel([*ready.stages, forest, IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=indexer.labels)])
    finally:
        data.unpersist()


def fit_regressor(train: DataFrame, features: Sequence[str], spec: ModelSpec,
                  label: str = "label") -> PipelineModel:
    """M5/M6: forest or boosted regression of ``label`` (double)."""
    data = fixed_layout(train, spec).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        feats = "scaledFeatures" if spec.scaled else "features"
        stages = [VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")]
        if spec.scaled:
            stages.append(MinMaxScaler(inputCol="features", outputCol="scaledFeatures", min=0.0, max=1.0))
        stages.append(_estimator(spec, label, feats))
        return Pipeline(stages=stages).fit(data)
    finally:
        data.unpersist()


def scoring_model(model: PipelineModel) -> PipelineModel:
    """A copy of ``model`` whose VectorAssembler keeps rows with NULL inputs
    (as NaN) instead of failing; callers null out those rows' scores."""
    stages = list(model.stages)
    first = stages[0]
    if isinstance(first, VectorAssembler):
        stages[0] = first.copy({first.handleInvalid: "keep"})
    return PipelineModel(stages)


def all_present(features: Sequence[str]):
    """Column: every feature of the row is non-NULL (and not NaN)."""
    cond = None
    for c in features:
        ok = F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
        cond = ok if cond is None else cond & ok
    return cond


def label_indexer_of(model: PipelineModel):
    for st in model.stages:
        if hasattr(st, "labels") and st.__class__.__name__ == "StringIndexerModel":
            return st
    raise ValueError("pipeline has no fitted StringIndexerModel")


def renamed_outputs(model: PipelineModel, vector: str, prefix: str) -> PipelineModel:
    """A copy of a fitted pipeline that starts from the feature vector ``vector`` and
    whose columns all begin with ``prefix``, so that several fit in one frame."""
    names, stages = {}, []
    for st in model.stages:
        kind = st.__class__.__name__
        if kind == "VectorAssembler":
            names[st.getOutputCol()] = vector
            continue
        if kind == "StringIndexerModel":          # indexes the label, which prediction does without
            continue
        own = {}
        for param in ("inputCol", "featuresCol"):
            if st.hasParam(param):
                own[st.getParam(param)] = names.get(st.getOrDefault(param), prefix + st.getOrDefault(param))
        for param in ("outputCol", "predictionCol", "probabilityCol", "rawPredictionCol"):
            if st.hasParam(param):
                names[st.getOrDefault(param)] = own[st.getParam(param)] = prefix + st.getOrDefault(param)
        stages.append(st.copy(own))
    return PipelineModel(stages)


def feature_vector(columns: Sequence[str]):
    """The vector of these columns; a NULL is NaN, as the assembler keeps it."""
    nan = F.lit(float("nan"))
    return array_to_vector(F.array(*[F.coalesce(F.col(c).cast("double"), nan) for c in columns]))


def proba_columns():
    """Proba_1, Proba_2 = probability of class index 0 and 1."""
    return (vector_element("probability", 0).alias("Proba_1"),
            vector_element("probability", 1).alias("Proba_2"))


def probability_frame(predictions: DataFrame, key: str = KEY) -> DataFrame:
    """(key, Proba_1, Proba_2)."""
    return predictions.select(key, *proba_columns())


def good_probability(model: PipelineModel, good_label: float = GOOD_LABEL, prefix: str = ""):
    """Column: P(label == good_label), located through the fitted label order
    (index 0 is the *most frequent* label, which need not be the good one)."""
    idx = label_position(label_indexer_of(model), good_label)
    return vector_element(f"{prefix}probability", idx)


def score_column(model: PipelineModel, spec: ModelSpec, good_label: float = GOOD_LABEL, prefix: str = ""):
    """X6 (probability mode) or X5 (label mode: 350 or 850)."""
    if spec.score_mode == "label":
        return score_from_probability(F.col(f"{prefix}predictedLabel").cast("double"))
    return score_from_probability(good_probability(model, good_label, prefix))
