"""Application jobs: train (C1/C3), predict (C2/C4), combine.

Every job takes the caller's SparkSession / DataFrames and returns frames;
nothing is printed and nothing exits the process.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.functions.expressions import label_to_double, vector_element
from ratecraft.operators import evaluate as ev
from ratecraft.operators.combine import combine_scores, weighted
from ratecraft.operators.describe import describe_column
from ratecraft.operators.outliers import Bounds
from ratecraft.plans.forests import StoredForest, let_go, with_votes
from ratecraft.plans.models import (
    KEY, MODULE_MODELS, ModelSpec, all_present, feature_vector, fit_classifier, good_probability,
    label_indexer_of, renamed_outputs, score_column, scoring_model)
from ratecraft.plans.views import LABEL, VIEWS, build_all_views, build_view, fit_view_bounds, split_view
from ratecraft.sources.manifest import ModelManifest
from ratecraft.sources.score_tables import ScoreTable
from ratecraft.sources.writers import ModelStore, stage

MODULES = ("consume", "finance", "interaction", "people", "relation")
SCORE_COLUMNS = {
    "consume": "ScoreConsume", "finance": "ScoreFinance", "interaction": "ScoreInteraction",
    "people": "ScorePeople", "relation": "ScoreRelation",
}


@dataclass
class Trained:
    module: str
    spec: ModelSpec
    model: PipelineModel
    bounds: Bounds | None
    report: dict               # accuracy, test_error, auc_roc, auc_pr, n, n_excluded on the evaluation rows
    curve: DataFrame | None = None   # precision, recall, F1 and F-beta per threshold on them


def _check_module(module: str) -> None:
    if module not in MODULES:
        raise ValueError(f"unknown module {module!r}; expected one of {MODULES}")


def train(features: DataFrame, module: str, spec: ModelSpec | None = None,
          store: ModelStore | None = None, rel_error: float = 0.0,
          eval_on: str = "test", evaluate: bool = True, bounds: Bounds | None = None) -> Trained:
    """View -> hash split -> fit -> evaluate -> (save model + bounds).

    ``bounds`` of a clamped view are fitted unless given (merged from sketches of
    the parts, say).  ``evaluate=False`` skips the report (``Trained.report`` is empty)."""
    _check_module(module)
    spec = spec or MODULE_MODELS[module]
    vs = VIEWS[module]
    bounds = (bounds or fit_view_bounds(features, vs, rel_error)) if vs.clamp else None
    view = build_view(features, vs, "train", bounds=bounds)
    labelled = view.withColumn("label", label_to_double(LABEL)).drop(LABEL)
    tr, te = split_view(labelled)
    model = fit_classifier(tr, vs.features, spec)
    report, curve = {}, None
    if evaluate:
        scored = model.transform(te if eval_on == "test" else labelled)
        report_in = scored.select(F.col("predictedLabel").cast("double").alias("prediction"),
                                  good_probability(model).alias("score"), "label")
        metrics, curve = ev.classification_report(stage(report_in, "evaluation"))
        report = ev.report_metrics(metrics)
    if store is not None:
        store.save_model(module, model)
        if bounds is not None:
            bounds.to_df(features.sparkSession).write.mode("overwrite").parquet(store.bounds_path(module))
        types = dict(labelled.dtypes)
        ModelManifest(module, list(vs.features), {c: types[c] for c in vs.features}, dict(features.dtypes),
                      list(label_indexer_of(model).labels), asdict(spec), _bound_values(bounds)
                      ).save(features.sparkSession, store.manifest_path(module))
    return Trained(module, spec, model, bounds, report, curve)


def _bound_values(bounds: Bounds | None) -> dict[str, list]:
    return {} if bounds is None else {c: [bounds.center[c], bounds.lower.get(c), bounds.upper.get(c)] for c in bounds.columns}


def at_once(spark, work: Mapping[str, Callable], threads: int | None = None) -> dict:
    """The results of the functions of ``work``, run as concurrent jobs.

    Each runs in a thread that inherits the caller's local properties, in a
    scheduler pool of its own name, so under FAIR scheduling
    (``spark.scheduler.mode``) short stages of one do not wait for another.  The
    first failure is raised once all have ended."""
    def run(name, fn):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            return fn()
        finally:
            let_go(spark)

    with ThreadPoolExecutor(threads or max(1, len(work))) as pool:
        # wrapped here, so that every job has its own copy of the caller's properties
        started = {name: pool.submit(inheritable_thread_target(spark)(run), name, fn) for name, fn in work.items()}
    return {name: f.result() for name, f in started.items()}


def train_all(features: DataFrame, modules: Sequence[str] = MODULES, specs: Mapping[str, ModelSpec] | None = None,
              store: ModelStore | None = None, threads: int | None = None, **options) -> dict[str, Trained]:
    """C1 for several modules at once, as concurrent jobs.

    The modules share nothing but their input: pass a written or persisted table.
    A fit's tasks alone seldom fill a cluster (boosting is one small job after
    another), five fits do; trees are those of separate runs."""
    for m in modules:
        _check_module(m)
    specs = specs or {}
    return at_once(features.sparkSession, {
        m: (lambda m=m: train(features, m, specs.get(m), store, **options)) for m in modules}, threads)


def predict(features: DataFrame, module: str, model: PipelineModel, spec: ModelSpec | None = None,
            bounds: Bounds | None = None, fill_override=None, with_probabilities: bool = False,
            with_status: bool = False) -> DataFrame:
    """View (prediction phase, training bounds) -> transform -> score.

    Returns (uid_uid, Score<Module>) or, with ``with_probabilities``,
    (uid_uid, Proba_1, Proba_2, Score<Module>); ``with_status`` adds
    ``scored`` (all features present).  Every input row is kept: a customer
    with a NULL feature (unfilled views) gets NULL probabilities and score
    instead of a score computed from a missing value."""
    _check_module(module)
    spec = spec or MODULE_MODELS[module]
    vs = VIEWS[module]
    if vs.clamp and bounds is None:
        raise ValueError(f"{module}: pass the bounds fitted at training time")
    view = build_view(features, vs, "predict", bounds=bounds, fill_override=fill_override)
    pred = scoring_model(model).transform(view)
    ok = all_present(vs.features)
    guard = lambda c, name: F.when(ok, c).alias(name)
    out = [KEY]
    if with_probabilities:
        out += [guard(vector_element("probability", 0), "Proba_1"),
                guard(vector_element("probability", 1), "Proba_2")]
    out.append(guard(score_column(model, spec), SCORE_COLUMNS[module]))
    if with_status:
        out.append(ok.alias("scored"))
    return pred.select(*out)


def load(store: ModelStore, module: str, spark) -> tuple[PipelineModel, Bounds | None]:
    """S8 (+ the persisted bounds of the people view), checked against the manifest:
    the view's features and their order, the label order, the bounds."""
    manifest = ModelManifest.load(spark, store.manifest_path(module))
    manifest.check_features(VIEWS[module].features)
    model = store.load_model(module)
    manifest.check_labels(label_indexer_of(model).labels)
    bounds = None
    if VIEWS[module].clamp:
        bounds = Bounds.from_df(spark.read.parquet(store.bounds_path(module)))
    manifest.check_bounds(_bound_values(bounds))
    return model, bounds


def load_all(store: ModelStore, spark, modules: Sequence[str] = MODULES) -> dict[str, tuple[PipelineModel, Bounds | None]]:
    """S8 for several modules at once."""
    return at_once(spark, {m: (lambda m=m: load(store, m, spark)) for m in modules})


def predict_all(features: DataFrame, models: Mapping[str, tuple[PipelineModel, Bounds | None]],
                specs: Mapping[str, ModelSpec] | None = None, fill_overrides: dict | None = None) -> DataFrame:
    """C2 for several modules in one pass: (uid_uid, one score per module).

    One scan of the features, one projection with all views, and each model's
    transform over its own view's vector; scores are those of the separate jobs."""
    specs = specs or {}
    bounds = next((b for m, (_, b) in models.items() if VIEWS[m].clamp), None)
    if bounds is None and any(VIEWS[m].clamp for m in models):
        raise ValueError("people: pass the bounds fitted at training time")
    df = build_all_views(features, "predict", bounds=bounds or Bounds("none"), fill_overrides=fill_overrides, modules=list(models))
    out, stages = [], {}
    for m, (model, _) in models.items():
        columns, prefix = [f"{m}.{c}" for c in VIEWS[m].features], f"_{m}_"
        df, stages[m] = df.withColumn(f"{prefix}vector", feature_vector(columns)), list(renamed_outputs(model, f"{prefix}vector", prefix).stages)
        if any(isinstance(st, StoredForest) for st in stages[m]):
            while not isinstance(stages[m][0], StoredForest):
                df = stages[m].pop(0).transform(df)
    stored = [st for m in models for st in stages[m] if isinstance(st, StoredForest)]
    df = with_votes(df, stored) if stored else df
    for m, (model, _) in models.items():
        columns, prefix = [f"{m}.{c}" for c in VIEWS[m].features], f"_{m}_"
        df = PipelineModel(stages[m]).transform(df)
        score = score_column(model, specs.get(m) or MODULE_MODELS[m], prefix=prefix)
        out.append(F.when(all_present(columns), score).alias(SCORE_COLUMNS[m]))
    return df.select(KEY, *out)


def all_scores(store: ModelStore) -> ScoreTable:
    """The table of all modules' scores, one row per customer."""
    return store.scores("all")


def predict_all_and_save(features: DataFrame, store: ModelStore, mode: str = "errorifexists",
                         specs: Mapping[str, ModelSpec] | None = None) -> DataFrame:
    """C4 for all modules: load the models at once, one pass, one table of five scores."""
    models = load_all(store, features.sparkSession)
    for m, (_, bounds) in models.items():
        _check_types(features, m, store, bounds)
    return all_scores(store).write(predict_all(features, models, specs), mode)


def _check_types(features: DataFrame, module: str, store: ModelStore, bounds: Bounds | None) -> None:
    """The view to predict from has the types that the model was fitted on."""
    manifest = ModelManifest.load(features.sparkSession, store.manifest_path(module))
    manifest.check_types(dict(build_view(features, module, "predict", bounds=bounds).dtypes))


def combine_all(spark, store: ModelStore) -> DataFrame:
    """C5 on the table of all scores: the same combination without a join."""
    return weighted(all_scores(store).read(spark))


def predict_and_save(features: DataFrame, module: str, store: ModelStore, mode: str = "errorifexists",
                     spec: ModelSpec | None = None) -> DataFrame:
    """C4: load model (+bounds), score, write the sub-score table (S5) as a new
    version; the one before stays current until it is whole."""
    model, bounds = load(store, module, features.sparkSession)
    _check_types(features, module, store, bounds)
    return store.scores(module).write(predict(features, module, model, spec, bounds), mode)


def predict_each_and_save(features: DataFrame, store: ModelStore, mode: str = "errorifexists",
                          specs: Mapping[str, ModelSpec] | None = None, modules: Sequence[str] = MODULES,
                          threads: int | None = None) -> dict[str, DataFrame]:
    """C4 for several modules as concurrent jobs: one sub-score table each.

    Every job scans the features; their loading, planning and commits overlap."""
    specs = specs or {}
    return at_once(features.sparkSession, {
        m: (lambda m=m: predict_and_save(features, m, store, mode, specs.get(m))) for m in modules}, threads)


def combine(spark, store: ModelStore) -> DataFrame:
    """Read the current sub-score tables (S6) and combine them (J1 + J2); they
    are bucketed by the key, so the joins do not shuffle."""
    return combine_scores({SCORE_COLUMNS[m]: store.scores(m).read(spark) for m in MODULES})


# ---- entry points (C3, C4, C5) ------------------------------------------------
def read_features(spark, path: str, fmt: str = "csv", rename: dict[str, str] | None = None,
                  max_rejected: float = 0.0) -> DataFrame:
    """The per-customer input table: CSV with header (S1), JSON lines (S2),
    Parquet, or a catalog table name (S3) -- always with the declared schema.
    A CSV is read by column name and needs no label (prediction does without);
    ``rename`` maps its names to the declared ones.  Rows that do not fit the
    schema are left out and written apart; more than ``max_rejected`` of all (a
    share) raise."""
    from ratecraft.sources.readers import read_csv_checked, read_json, read_parquet, read_table
    from ratecraft.sources.schemas import feature_schema
    schema = feature_schema()
    if fmt == "csv":
        return read_csv_checked(spark, path, schema, rename, (LABEL,), max_rejected).rows
    if fmt == "json":
        return read_json(spark, path, schema)
    if fmt == "parquet":
        return read_parquet(spark, path, schema)
    if fmt == "table":
        return read_table(spark, path)
    raise ValueError(f"unknown format {fmt!r}")


def train_module(spark, module: str, data_path: str, store: ModelStore, fmt: str = "csv",
                 spec: ModelSpec | None = None, rename: dict[str, str] | None = None, max_rejected: float = 0.0) -> Trained:
    """``train <module> <path>``; saves the model, returns it with its report."""
    _check_module(module)
    return train(read_features(spark, data_path, fmt, rename, max_rejected), module, spec, store=store)


def predict_module(spark, module: str, data_path: str, store: ModelStore, fmt: str = "csv",
                   spec: ModelSpec | None = None, mode: str = "errorifexists",
                   rename: dict[str, str] | None = None, max_rejected: float = 0.0) -> DataFrame:
    """C4: ``predict <module> <path>``; writes and returns the sub-score table."""
    _check_module(module)
    return predict_and_save(read_features(spark, data_path, fmt, rename, max_rejected), module, store, mode=mode, spec=spec)


def combine_result(spark, store: ModelStore) -> tuple[DataFrame, DataFrame]:
    """``combine``; the combined scores and the description (A2) of ScoreAll."""
    combined = combine(spark, store)
    return combined, describe_column(combined, "ScoreAll")


def train_regressor(features: DataFrame, module: str, spec: ModelSpec,
                    store: ModelStore | None = None) -> tuple[PipelineModel, float | None]:
    """M5/M6: forest or boosted regression of the label on one view's
    features, fitted on the hash-train rows; returns (model, RMSE on the
    held-out rows)."""
    from ratecraft.plans.models import fit_regressor
    _check_module(module)
    vs = VIEWS[module]
    bounds = fit_view_bounds(features, vs) if vs.clamp else None
    view = build_view(features, vs, "train", bounds=bounds)
    labelled = view.withColumn("label", label_to_double(LABEL)).drop(LABEL)
    tr, te = split_view(labelled)
    model = fit_regressor(tr, vs.features, spec)
    rmse = ev.rmse(model.transform(te), "prediction", "label").first()["rmse"]   # on the held-out rows
    if store is not None:
        store.save_model(f"{module}_{spec.kind}", model)
    return model, rmse
