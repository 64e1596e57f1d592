"""Bounds fit/apply and quantiles against hand-computed and brute-force values."""

import math

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ratecraft.operators.outliers import apply_bounds, fit_bounds, outlier_rows
from ratecraft.operators.quantiles import approx_quantiles, exact_quantiles


def _one_to_100(spark):
    return spark.createDataFrame([(i,) for i in range(1, 101)], "x int")


def _apply(spark, b, values):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    return [r[0] for r in apply_bounds(df, b).select("x_new").collect()]


def test_clamp_mode_95(spark):
    b = fit_bounds(_one_to_100(spark), ["x"], "clamp95", rel_error=0.0)
    assert b.center["x"] == 50 and b.upper["x"] == 95
    assert _apply(spark, b, [-1, 95, 96, None]) == [50.0, 95.0, 95.0, None]


def test_clamp_mode_5(spark):
    b = fit_bounds(_one_to_100(spark), ["x"], "clamp5", rel_error=0.0)
    assert _apply(spark, b, [-1, 95, 96, None]) == [50.0, 95.0, 50.0, None]


def test_iqr(spark):
    b = fit_bounds(_one_to_100(spark), ["x"], "iqr", rel_error=0.0)
    assert (b.lower["x"], b.upper["x"], b.center["x"]) == (-50.0, 150.0, 50.0)
    df = spark.createDataFrame([(150,), (151,), (-50,), (-51,), (-1,)], "x int")
    rows = apply_bounds(df, b).collect()
    assert [r.x_new for r in rows] == [150.0, 50.0, -50.0, 50.0, -1.0]
    assert [r.xTF for r in rows] == [1, 1, 1, 1, 0]
    assert "x" not in apply_bounds(df, b).columns


def test_outlier_rows_lists_every_row(spark):
    b = fit_bounds(_one_to_100(spark), ["x"], "iqr", rel_error=0.0)
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate([150, 151, -51, 7])], "uid_uid string, x int")
    got = sorted(r.value for r in outlier_rows(df, b).collect())
    assert got == [-51.0, 151.0]


def test_sigma(spark):
    vals = [10] * 20 + [1000]
    df = spark.createDataFrame([(v,) for v in vals], "x int")
    b = fit_bounds(df, ["x"], "sigma")
    mean, sd = np.mean(vals), np.std(vals, ddof=1)
    assert math.isclose(b.center["x"], mean) and math.isclose(b.upper["x"], mean + 3 * sd)
    out = [r[0] for r in apply_bounds(df, b).collect()]
    assert out[:20] == [10.0] * 20


def _disc(values, p):
    s = sorted(values)
    return s[max(1, math.ceil(p * len(s))) - 1]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-5, 40), min_size=1, max_size=300),
       st.lists(st.integers(0, 3), min_size=1, max_size=300))
def test_exact_quantiles_match_brute_force(spark, xs, ys):
    m = max(len(xs), len(ys))
    df = spark.createDataFrame([(xs[i] if i < len(xs) else None, ys[i] if i < len(ys) else None)
                                for i in range(m)], "a int, b int")
    probs = [0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = {(r.column, r.p): r.value for r in exact_quantiles(df, ["a", "b"], probs).collect()}
    for c, vals in (("a", xs), ("b", ys)):
        for p in probs:
            assert got[(c, p)] == _disc(vals, p), (c, p)


def test_exact_quantiles_many_distinct_values(spark):
    rng = np.random.default_rng(7)
    vals = rng.normal(size=5000).round(5).tolist()
    df = spark.createDataFrame([(v,) for v in vals], "a double").repartition(5)
    probs = [0.001, 0.3, 0.5, 0.95, 0.999]
    got = {r.p: r.value for r in exact_quantiles(df, ["a"], probs).collect()}
    for p in probs:
        assert got[p] == _disc(vals, p)


def test_approx_quantiles_within_rank_error(spark):
    vals = list(range(1, 1001))
    df = spark.createDataFrame([(v,) for v in vals], "a int")
    eps = 0.1
    q = approx_quantiles(df, ["a"], [0.25, 0.5, 0.95], eps)["a"]
    for p, v in zip([0.25, 0.5, 0.95], q):
        rank = sum(1 for x in vals if x <= v)
        assert abs(rank - p * len(vals)) <= eps * len(vals) + 1


def test_bounds_roundtrip_table(spark):
    b = fit_bounds(_one_to_100(spark), ["x"], "clamp95", rel_error=0.0)
    from ratecraft.operators.outliers import Bounds
    b2 = Bounds.from_df(b.to_df(spark))
    assert b2 == b


def test_exact_quantiles_with_a_hot_value(spark):
    # one value holds a third of the rows: it is one count row, not a hot task
    vals = [7] * 3000 + list(range(6000))
    df = spark.createDataFrame([(v,) for v in vals], "a int").repartition(8)
    probs = [0.1, 0.34, 0.5, 0.9]
    got = {r.p: r.value for r in exact_quantiles(df, ["a"], probs).collect()}
    for p in probs:
        assert got[p] == _disc(vals, p)
