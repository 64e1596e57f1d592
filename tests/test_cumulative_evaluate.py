"""Running sums vs pandas; curves and areas vs hand values and Spark ML."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ratecraft.operators import evaluate as ev
from ratecraft.operators.cumulative import cumulative_sums


@pytest.mark.parametrize("descending", [False, True])
def test_cumulative_sums_match_pandas(spark, descending):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 3000), "k": rng.integers(0, 400, 3000).astype(float),
                        "v": rng.integers(0, 10, 3000)})
    df = spark.createDataFrame(pdf).repartition(6)
    got = cumulative_sums(df, ["g"], "k", ["v"], descending=descending, num_partitions=16).toPandas()
    for _, r in got.sample(200, random_state=1).iterrows():
        grp = pdf[pdf.g == r.g]
        sel = grp.k >= r.k if descending else grp.k <= r.k
        assert r.cum_v == grp[sel].v.sum()


def test_cumulative_sums_no_group(spark):
    pdf = pd.DataFrame({"k": np.arange(1000) % 97, "v": np.ones(1000, dtype=int)})
    got = cumulative_sums(spark.createDataFrame(pdf), [], "k", ["v"]).toPandas()
    for _, r in got.iterrows():
        assert r.cum_v == (pdf.k <= r.k).sum()


def _fixture_pairs(spark):
    return spark.createDataFrame([(0.0, 1.0), (1.0, 1.0), (1.0, 0.0), (1.0, 1.0)], "score double, label double")


def test_threshold_curve_hand_values(spark):
    rows = {r.threshold: r for r in ev.threshold_curve(_fixture_pairs(spark)).collect()}
    assert rows[1.0].precision == pytest.approx(2 / 3) and rows[1.0].recall == pytest.approx(2 / 3)
    assert rows[0.0].precision == 0.75 and rows[0.0].recall == 1.0


def test_areas_hand_values(spark):
    r = ev.auc(_fixture_pairs(spark)).first()
    assert r.auc_roc == pytest.approx(1 / 3)
    assert r.auc_pr == pytest.approx(0.680556, abs=1e-6)


def test_areas_match_spark_ml(spark):
    rng = np.random.default_rng(11)
    n = 2000
    label = rng.integers(0, 2, n).astype(float)
    score = np.clip(label * 0.3 + rng.normal(0.4, 0.25, n), 0, 1).round(3)
    df = spark.createDataFrame(pd.DataFrame({"score": score, "label": label}))
    mine = ev.auc(df).first()
    raw = df.select(array_to_vector(F.array(1 - F.col("score"), F.col("score"))).alias("raw"), "label")
    for metric, val in (("areaUnderROC", mine.auc_roc), ("areaUnderPR", mine.auc_pr)):
        ref = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label", metricName=metric,
                                            numBins=0).evaluate(raw)
        assert abs(ref - val) < 1e-6, metric


def test_rmse_and_accuracy(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (1.0, 0.0), (0.0, 0.0)], "prediction double, label double")
    assert ev.rmse(df).first().rmse == pytest.approx(np.sqrt(0.5))
    a = ev.accuracy(df).first()
    assert a.accuracy == 0.5 and a.test_error == 0.5


def test_recall_is_monotone_on_real_data(spark, features_small):
    from ratecraft.plans.rule_scores import eval_frame
    cur = ev.threshold_curve(eval_frame(features_small)).orderBy(F.desc("threshold")).toPandas()
    assert (np.diff(cur.recall.values) >= -1e-12).all()


def test_slices_follow_the_setting_and_do_not_change_the_sums(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": rng.integers(0, 300, 2000).astype(float), "v": rng.integers(0, 5, 2000)})
    df = spark.createDataFrame(pdf)
    sums = [{r.k: r.cum_v for r in cumulative_sums(df, [], "k", ["v"], descending=True, num_partitions=n).collect()}
            for n in (None, 2, 7, 200)]
    assert all(s == sums[0] for s in sums)


def test_running_sums_keep_long_keys_apart(spark):
    big = 1 << 60
    df = spark.createDataFrame([(big, 1), (big + 1, 1), (big + 2, 1)], "k long, v long")
    assert sorted(r.cum_v for r in cumulative_sums(df, [], "k", ["v"]).collect()) == [1, 2, 3]
    assert {r.k - big: r.cum_v for r in cumulative_sums(df, [], "k", ["v"], descending=True).collect()} == {0: 3, 1: 2, 2: 1}


def test_one_rule_for_missing_predictions(spark):
    df = spark.createDataFrame([(1.0, 0.9, 1.0), (None, None, 1.0)], "prediction double, score double, label double")
    assert ev.accuracy(df).first().accuracy == 1.0
    metrics = ev.report_metrics(ev.classification_report(df)[0])
    assert metrics["accuracy"] == 1.0 and metrics["n"] == 1.0 and metrics["n_excluded"] == 1.0


def test_report_has_metrics_and_curve(spark, features_small):
    from ratecraft.plans.rule_scores import eval_frame
    e = eval_frame(features_small)
    metrics, curve = ev.classification_report(e, "prediction", "score", "label")
    found = ev.report_metrics(metrics)
    areas = ev.auc(e).first()
    assert abs(found["auc_roc"] - areas.auc_roc) < 1e-9 and abs(found["auc_pr"] - areas.auc_pr) < 1e-9
    assert found["n"] + found["n_excluded"] == e.count()
    key = lambda r: r.threshold
    assert sorted(curve.collect(), key=key) == sorted(ev.threshold_curve(e).collect(), key=key)


def test_no_bounds_in_the_plan_and_any_number_of_ranges(spark):
    """A row finds its range by the partitioner: the plan does not grow with the partitions, and sums stay the same."""
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 3).alias("g"), F.lit(1).alias("v"))
    old, plans, sums = spark.conf.get("spark.sql.shuffle.partitions"), [], []
    try:
        for n in ("4", "400"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out = cumulative_sums(df, ["g"], "k", ["v"])
            plans.append(out._jdf.queryExecution().optimizedPlan().toString())
            sums.append(sorted(map(tuple, out.collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sums[0] == sums[1] and len(sums[0]) == 5000
    assert abs(len(plans[0]) - len(plans[1])) < 300 and not any("percentile" in p or "array(" in p for p in plans)


def test_a_hot_group_and_text_keys(spark):
    rows = [("hot", f"k{i:04d}", 1) for i in range(900)] + [("cold", f"k{i:04d}", 2) for i in range(0, 900, 300)]
    got = cumulative_sums(spark.createDataFrame(rows, "g string, k string, v long").repartition(5), ["g"], "k", ["v"], num_partitions=7)
    assert {(r.g, r.k): r.cum_v for r in got.collect()} == {
        **{("hot", f"k{i:04d}"): i + 1 for i in range(900)}, **{("cold", f"k{i:04d}"): 2 * (i // 300 + 1) for i in range(0, 900, 300)}}
