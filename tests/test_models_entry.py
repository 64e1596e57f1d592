"""Model behaviour (learnable toy set), reproducibility, persistence, entry."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ratecraft.plans.models import ModelSpec, fit_classifier, good_probability, probability_frame
from ratecraft.session import scratch_path
from ratecraft.operators import evaluate as ev


def _toy(spark, n=600, good_share=0.25, seed=5):
    rng = np.random.default_rng(seed)
    label = (rng.random(n) < good_share).astype(float)
    pdf = pd.DataFrame({"uid_uid": [f"u{i:05d}" for i in range(n)], "label": label,
                        "a": label * 3 + rng.normal(0, 0.5, n), "b": rng.normal(0, 1, n)})
    return spark.createDataFrame(pdf)


SPEC = ModelSpec("rfc", trees=10, max_depth=4, impurity="gini", rows_per_partition=150)


def test_minority_good_label_still_scores_upward(spark):
    df = _toy(spark)
    model = fit_classifier(df, ["a", "b"], SPEC)
    pred = model.transform(df).select("label", good_probability(model).alias("score"))
    assert ev.auc(pred).first().auc_roc > 0.9
    means = {r.label: r.m for r in pred.groupBy("label").agg(F.avg("score").alias("m")).collect()}
    assert means[1.0] > means[0.0]


def test_same_seed_any_input_layout_same_probabilities(spark):
    df = _toy(spark)
    m1 = fit_classifier(df.repartition(3), ["a", "b"], SPEC)
    m2 = fit_classifier(df.repartition(9).orderBy(F.rand(1)), ["a", "b"], SPEC)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        m3 = fit_classifier(df, ["a", "b"], SPEC)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    p1 = {r.uid_uid: r.Proba_1 for r in probability_frame(m1.transform(df)).collect()}
    p2 = {r.uid_uid: r.Proba_1 for r in probability_frame(m2.transform(df)).collect()}
    p3 = {r.uid_uid: r.Proba_1 for r in probability_frame(m3.transform(df)).collect()}
    assert p1 == p2 == p3


def test_training_tasks_follow_the_row_count(spark):
    """A function of the rows alone: ten times the rows, ten times the partitions, under any setting."""
    from ratecraft.plans.models import fixed_layout
    spec, old = ModelSpec("rfc", trees=1, max_depth=1, rows_per_partition=100), spark.conf.get("spark.sql.shuffle.partitions")
    for n, expected in ((0, 1), (100, 1), (101, 2), (1_000, 10), (10_000, 100)):
        layouts = []
        for setting in ("2", "31"):
            spark.conf.set("spark.sql.shuffle.partitions", setting)
            try:
                df = spark.range(n).select(F.col("id").cast("string").alias("uid_uid")).repartition(7)
                laid = fixed_layout(df, spec)
                assert laid.rdd.getNumPartitions() == expected
                layouts.append([(r.p, r.uid_uid) for r in laid.select(F.spark_partition_id().alias("p"), "uid_uid").collect()])
            finally:
                spark.conf.set("spark.sql.shuffle.partitions", old)
        assert layouts[0] == layouts[1] and len(layouts[0]) == n


def test_training_tasks_of_the_registered_models_do_not_grow_with_small_partitions(spark):
    """Each task holds all nodes' statistics: 630,000 rows were 420 tasks of every level."""
    from ratecraft.plans.models import FOREST_REGRESSOR, GBT_REGRESSOR, MODULE_MODELS, fixed_layout
    for spec in (*MODULE_MODELS.values(), FOREST_REGRESSOR, GBT_REGRESSOR):
        got = [fixed_layout(spark.range(n).select(F.col("id").cast("string").alias("uid_uid")), spec).rdd.getNumPartitions()
               for n in (1_500, 10_500, 630_000, 12_000_000)]
        assert got == [1, 7, 12, 24]


def test_save_load_identical_probabilities(spark):
    from pyspark.ml import PipelineModel
    df = _toy(spark)
    m = fit_classifier(df, ["a", "b"], SPEC)
    path = scratch_path(spark, "model")
    m.write().overwrite().save(path)
    m2 = PipelineModel.load(path)
    a = probability_frame(m.transform(df)).orderBy("uid_uid").collect()
    b = probability_frame(m2.transform(df)).orderBy("uid_uid").collect()
    assert a == b
    assert all(abs(r.Proba_1 + r.Proba_2 - 1) < 1e-9 for r in a)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    out = e.entry(spark)
    assert out.columns == ["uid_uid", "Proba_1", "Proba_2", "ScoreRelation"]
    rows = out.collect()
    assert len(rows) > 0 and all(350 <= r.ScoreRelation <= 850 for r in rows)


def test_every_query_has_oracle_or_is_listed(spark):
    import __spark_entry__ as e
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


def test_path_entry_points_and_unknown_module(spark, features_small):
    import pytest
    from ratecraft.plans import jobs
    from ratecraft.plans.models import small_spec
    from ratecraft.sources.writers import ModelStore
    path = scratch_path(spark, "csvin")
    features_small.write.option("header", True).csv(path)
    store = ModelStore(scratch_path(spark, "store"))
    trained = jobs.train_module(spark, "relation", path, store, spec=small_spec("relation"))
    assert set(trained.report) >= {"accuracy", "auc_roc", "auc_pr"}
    assert set(trained.curve.columns) >= {"threshold", "precision", "recall", "f1", "f_beta"}
    scores = jobs.predict_module(spark, "relation", path, store, spec=small_spec("relation"))
    assert scores.count() == features_small.count()
    with pytest.raises(ValueError):
        jobs.train_module(spark, "nosuch", path, store)


def test_random_split_option(spark, features_small):
    from ratecraft.plans.views import build_view, split_view
    v = build_view(features_small, "relation", "train")
    tr, te = split_view(v, "random", seed=3)
    assert tr.count() + te.count() == v.count()


def test_regression_jobs_report_rmse(spark, features_small):
    from ratecraft.plans import jobs
    from ratecraft.plans.models import FOREST_REGRESSOR, GBT_REGRESSOR
    for spec in (FOREST_REGRESSOR.small(5, 3), GBT_REGRESSOR.small(5, 3)):
        _, rmse = jobs.train_regressor(features_small, "relation", spec)
        assert rmse is not None and 0 <= rmse <= 1


def test_eval_on_all_rows_vs_held_out(spark, features_small):
    from ratecraft.plans import jobs
    from ratecraft.plans.models import small_spec
    from ratecraft.plans.views import build_view, split_view
    view = build_view(features_small, "relation", "train")
    _, te = split_view(view)
    held = jobs.train(features_small, "relation", small_spec("relation")).report
    every = jobs.train(features_small, "relation", small_spec("relation"), eval_on="all").report
    assert held["n"] == te.count() and every["n"] == view.count()


def test_interaction_probability_score_mode(spark, features_small):
    from dataclasses import replace
    from ratecraft.plans import jobs
    from ratecraft.plans.models import small_spec
    label_spec = small_spec("interaction")
    prob_spec = replace(label_spec, score_mode="probability")
    t = jobs.train(features_small, "interaction", label_spec, evaluate=False)
    hard = {r.ScoreInteraction for r in jobs.predict(features_small, "interaction", t.model, label_spec).collect()}
    soft = [r.ScoreInteraction for r in jobs.predict(features_small, "interaction", t.model, prob_spec).collect()]
    assert hard <= {350.0, 850.0}
    assert all(350 <= s <= 850 for s in soft) and len(set(soft)) > 2
