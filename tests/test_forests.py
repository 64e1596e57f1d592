"""Forests kept as a table of nodes: Spark's numbers, in parts, saved and loaded."""

from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ratecraft.operators import evaluate as ev
from ratecraft.plans import forests, models
from ratecraft.plans.models import ModelSpec, fit_classifier, good_probability, probability_frame, scoring_model
from ratecraft.session import scratch_path

SPEC = ModelSpec("rfc", trees=7, max_depth=6, impurity="gini", rows_per_partition=150, nodes_whole=0, nodes_at_once=60)


@pytest.fixture(scope="module")
def toy(spark):
    rng = np.random.default_rng(3)
    label = (rng.random(700) < 0.3).astype(float)
    return spark.createDataFrame(pd.DataFrame({
        "uid_uid": [f"u{i:05d}" for i in range(700)], "label": label, "a": label * 2 + rng.normal(0, 1, 700), "b": rng.normal(0, 1, 700)})).cache()


def test_votes_are_those_of_sparks_model(spark, toy):
    """Also for a missing feature, with trees read again and in two parts."""
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features", handleInvalid="keep").transform(
        toy.withColumn("b", F.when(F.col("uid_uid").endswith("7"), None).otherwise(F.col("b")))).repartition(3)
    fit = [RandomForestClassifier(numTrees=n, maxDepth=9, seed=n).fit(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(toy)) for n in (5, 2)]
    folder = scratch_path(spark, "forest")
    for i, model in enumerate(fit):
        forests.add_trees(model, folder, 5 * i, spark)
    stored = forests.StoredForest(folder=folder, classes=2)
    want = {r.uid_uid: r for r in fit[1].transform(fit[0].transform(rows).select("uid_uid", "features", F.col("rawPrediction").alias("first"))).collect()}
    got = stored.transform(rows).collect()
    assert len(got) == 700
    for r in got:
        raw = want[r.uid_uid].first.toArray() + want[r.uid_uid].rawPrediction.toArray()
        assert r.rawPrediction.toArray() == pytest.approx(raw, abs=1e-12)
        assert r.probability.toArray() == pytest.approx(raw / raw.sum(), abs=1e-12) and r.prediction == raw.argmax()
    # one part: number for number, also where no tree is kept
    folder = scratch_path(spark, "forest")
    forests.add_trees(fit[0], folder, 0, spark)
    one = forests.StoredForest(folder=folder, classes=2)
    assert ({r.uid_uid: (r.rawPrediction, r.probability, r.prediction) for r in one.transform(rows).collect()}
            == {r.uid_uid: (r.rawPrediction, r.probability, r.prediction) for r in fit[0].transform(rows).collect()})
    from pyspark.ml.functions import vector_to_array
    again = forests._votes([one.nodes().inputFiles()], [2], kept_nodes=10, rows_at_once=50)
    kept = forests._votes([one.nodes().inputFiles()], [2])
    x = vector_to_array(F.col("features"))
    assert rows.select(again(x).alias("v"), "uid_uid").exceptAll(rows.select(kept(x).alias("v"), "uid_uid")).count() == 0


def test_a_forest_of_many_nodes_is_fitted_in_parts(spark, toy, monkeypatch):
    """No fit has more than its share of the nodes, and no model but the fits' own is on the driver."""
    parts, add = [], forests.add_trees
    monkeypatch.setattr(forests, "add_trees", lambda model, folder, first, session: (parts.append((first, model.getNumTrees, model.totalNumNodes)), add(model, folder, first, session))[1])
    model = fit_classifier(toy, ["a", "b"], SPEC)
    assert parts[0][:2] == (0, 1) and sum(n for _, n, _ in parts) == 7 and len(parts) > 2
    assert not any(hasattr(s, "trees") for s in model.stages)
    stored = next(s for s in model.stages if isinstance(s, forests.StoredForest))
    assert stored.nodes().select("tree").distinct().count() == 7 and stored.nodes().count() == sum(n for *_, n in parts)
    assert ev.auc(model.transform(toy).select("label", good_probability(model).alias("score"))).first().auc_roc > 0.9
    # the same rows in another layout: the same trees
    other = fit_classifier(toy.repartition(5), ["a", "b"], SPEC)
    want = probability_frame(model.transform(toy)).orderBy("uid_uid").collect()
    assert probability_frame(other.transform(toy)).orderBy("uid_uid").collect() == want
    # saved beside another model of the same path, and loaded
    path = scratch_path(spark, "model")
    other.write().save(path)
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    assert probability_frame(loaded.transform(toy)).orderBy("uid_uid").collect() == want
    # a missing feature does not fail, and the columns can be renamed
    some = toy.withColumn("b", F.when(F.col("uid_uid").endswith("3"), None).otherwise(F.col("b")))
    assert scoring_model(loaded).transform(some).count() == 700
    renamed = models.renamed_outputs(loaded, "v", "_m_").transform(toy.withColumn("v", models.feature_vector(["a", "b"])))
    assert [r.p for r in renamed.orderBy("uid_uid").select(good_probability(loaded, prefix="_m_").alias("p")).collect()] == pytest.approx(
        [r.p for r in loaded.transform(toy).orderBy("uid_uid").select(good_probability(loaded).alias("p")).collect()])


def test_the_registered_forests_are_kept_whole_while_they_are_small():
    from ratecraft.plans.models import FOREST_CLASSIFIER as spec
    kept = [forests.whole(n, spec.trees, spec.max_depth, spec.nodes_whole) for n in (1, 1_050, 10_500, 630_000)]
    assert kept == [True, True, True, False]
    assert forests.whole(10**9, 10, 5, replace(spec, trees=10, max_depth=5).nodes_whole)


def test_five_modules_in_parts(spark):
    """Training at once, one-pass prediction and five jobs agree where every forest is kept as a table."""
    from ratecraft.plans import jobs
    from ratecraft.plans.features import materialize_feature_table
    from ratecraft.sources.writers import ModelStore
    features = materialize_feature_table(spark, "/root/testdata/sf0.001", scratch_path(spark, "features"))
    store, specs = ModelStore(scratch_path(spark, "models")), {}
    for m in jobs.MODULES:
        specs[m] = replace(models.small_spec(m), nodes_whole=0, nodes_at_once=100)
    jobs.train_all(features, specs=specs, store=store)
    jobs.predict_each_and_save(features, store, specs=specs)
    jobs.predict_all_and_save(features, store, specs=specs)
    plan = jobs.predict_all(features, jobs.load_all(store, spark), specs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("FileScan") == 1 and "Exchange" not in plan
    one = {r.uid_uid: r for r in jobs.combine_all(spark, store).collect()}
    each = {r.uid_uid: r for r in jobs.combine(spark, store).collect()}
    assert one.keys() == each.keys() and all(one[k][c] == r[c] for k, r in each.items() for c in r.__fields__)
