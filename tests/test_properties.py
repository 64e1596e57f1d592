"""Remaining properties of SURVEY section 5."""

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ratecraft.operators import evaluate as ev
from ratecraft.operators.indexing import fit_label_indexer
from ratecraft.operators.outliers import apply_bounds, fit_bounds
from ratecraft.operators.scaling import fit_minmax, unpack


def test_constant_feature_scales_to_half(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (2.0, 5.0)], "a double, b double")
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    out = unpack(fit_minmax(vec).transform(vec), "scaledFeatures", ["a_s", "b_s"]).collect()
    assert sorted(r.a_s for r in out) == [0.0, 0.5, 1.0]
    assert {r.b_s for r in out} == {0.5}


def test_single_class_label(spark):
    m = fit_label_indexer(spark.createDataFrame([(1.0,), (1.0,)], "label double"))
    assert list(m.labels) == ["1.0"]


def test_clamped_output_has_no_sentinel_unless_median_is_one(spark):
    rng = np.random.default_rng(2)
    vals = rng.integers(-1, 60, 2000).tolist()
    df = spark.createDataFrame([(int(v),) for v in vals], "x int")
    b = fit_bounds(df, ["x"], "clamp95", rel_error=0.0)
    out = [r[0] for r in apply_bounds(df, b).collect()]
    assert max(out) <= b.upper["x"]
    if b.center["x"] != -1:
        assert -1.0 not in out


def test_auc_unchanged_by_monotone_score_map(spark):
    rng = np.random.default_rng(4)
    n = 1500
    label = rng.integers(0, 2, n).astype(float)
    score = np.clip(label * 0.2 + rng.normal(0.5, 0.2, n), 0.001, 1).round(3)
    df = spark.createDataFrame(pd.DataFrame({"score": score, "label": label}))
    a = ev.auc(df).first()
    b = ev.auc(df.select((F.col("score") * F.col("score") * 7 + 1).alias("score"), "label")).first()
    assert a.auc_roc == b.auc_roc and a.auc_pr == b.auc_pr


def test_applying_bounds_does_not_read_the_batch(spark):
    fit_on = spark.createDataFrame([(i,) for i in range(100)], "x int")
    b = fit_bounds(fit_on, ["x"], "iqr", rel_error=0.0)
    batch = spark.range(0, 1000).select(F.col("id").cast("int").alias("x"))
    plan = apply_bounds(batch, b)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan
