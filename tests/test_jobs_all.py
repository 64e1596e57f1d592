"""All modules at once: concurrent training, one-pass prediction; manifests of saved models."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from ratecraft.plans import jobs
from ratecraft.plans.features import materialize_feature_table
from ratecraft.plans.models import small_spec
from ratecraft.session import scratch_path
from ratecraft.sources.manifest import ModelManifest, ModelMismatch
from ratecraft.sources.writers import ModelStore

SPECS = {m: small_spec(m) for m in jobs.MODULES}


@pytest.fixture(scope="module")
def features(spark):
    return materialize_feature_table(spark, "/root/testdata/sf0.001", scratch_path(spark, "features"))


@pytest.fixture(scope="module")
def trained(spark, features):
    store = ModelStore(scratch_path(spark, "models"))
    return store, jobs.train_all(features, specs=SPECS, store=store)


def test_trees_of_concurrent_fits_are_those_of_separate_ones(features, trained):
    for m, t in trained[1].items():
        alone = jobs.train(features, m, SPECS[m])
        trees = lambda x: next(s for s in x.model.stages if hasattr(s, "toDebugString")).toDebugString.split("\n", 1)[1]
        assert trees(alone) == trees(t)
        assert alone.report == pytest.approx(t.report, nan_ok=True)


def test_one_pass_gives_the_scores_of_five_jobs(spark, features, trained):
    store, _ = trained
    # some customers without a feature of an unfilled view
    some = features.withColumn("com_mobile_count", F.when(F.col("uid_uid").endswith("3"), None).otherwise(F.col("com_mobile_count")))
    wide = jobs.predict_all(some, jobs.load_all(store, spark), SPECS)
    assert wide.columns == ["uid_uid", *jobs.SCORE_COLUMNS.values()]
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    got = {r.uid_uid: r for r in wide.collect()}
    missing = 0
    for m, (model, bounds) in jobs.load_all(store, spark).items():
        c = jobs.SCORE_COLUMNS[m]
        alone = {r.uid_uid: r[c] for r in jobs.predict(some, m, model, SPECS[m], bounds).collect()}
        assert alone == {k: r[c] for k, r in got.items()}
        missing += sum(v is None for v in alone.values())
    assert missing > 0


def test_table_of_all_scores_combines_without_a_join(spark, features, trained):
    store, _ = trained
    each = jobs.predict_each_and_save(features, store, mode="overwrite", specs=SPECS)
    for m, (model, bounds) in jobs.load_all(store, spark).items():
        assert sorted(map(tuple, each[m].collect())) == sorted(map(tuple, jobs.predict(features, m, model, SPECS[m], bounds).collect()))
    jobs.predict_all_and_save(features, store, mode="overwrite", specs=SPECS)
    one = jobs.combine_all(spark, store)
    assert "Join" not in one._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, jobs.combine(spark, store).select(*one.columns).collect()))


def test_a_failure_in_one_job_is_raised(spark):
    done = []
    with pytest.raises(ZeroDivisionError):
        jobs.at_once(spark, {"a": lambda: 1 / 0, "b": lambda: done.append(spark.range(10).count())})
    assert done == [10]
    spark.sparkContext.setLocalProperty("ratecraft.test", "kept")
    got = jobs.at_once(spark, {m: (lambda: (spark.sparkContext.getLocalProperty("ratecraft.test"),
                                            spark.sparkContext.getLocalProperty("spark.scheduler.pool"))) for m in "xy"})
    assert got == {"x": ("kept", "x"), "y": ("kept", "y")} and spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_a_changed_view_is_refused_by_name(spark, features, trained, monkeypatch):
    store, _ = trained
    views = dict(jobs.VIEWS)
    spec = views["relation"]
    for changed, message in ((spec.features[:-1], "ord_success_order_cmobile_count"), ((*spec.features, "uid_grade"), "uid_grade"),
                             (spec.features[::-1], "another order")):
        monkeypatch.setitem(jobs.VIEWS, "relation", dataclasses.replace(spec, features=tuple(changed)))
        with pytest.raises(ModelMismatch, match=message):
            jobs.load(store, "relation", spark)
    monkeypatch.setitem(jobs.VIEWS, "relation", spec)
    jobs.load(store, "relation", spark)
    with pytest.raises(ModelMismatch, match="com_idno_count"):
        jobs.predict_and_save(features.withColumn("com_idno_count", F.col("com_idno_count").cast("double")), "relation", store, mode="overwrite")


def test_other_labels_bounds_or_no_manifest_are_refused(spark, features, trained):
    store, fitted = trained
    manifest = ModelManifest.load(spark, store.manifest_path("people"))
    assert manifest.features == list(jobs.VIEWS["people"].features) and manifest.parameters["trees"] == SPECS["people"].trees
    assert manifest.bounds == jobs._bound_values(fitted["people"].bounds) and set(manifest.feature_types) == set(manifest.features)
    with pytest.raises(ModelMismatch, match="labels"):
        manifest.check_labels(manifest.labels[::-1])
    other = {**manifest.bounds, "uid_signupdays": [0.0, 0.0, 0.0]}
    with pytest.raises(ModelMismatch, match="uid_signupdays"):
        manifest.check_bounds(other)
    with pytest.raises(ModelMismatch, match="no manifest"):
        jobs.load(ModelStore(scratch_path(spark, "nothing")), "people", spark)
