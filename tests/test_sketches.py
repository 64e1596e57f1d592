"""Mergeable quantile sketches: merged parts, repeated loads, empty and odd columns, bounds without a refit."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ratecraft.operators.outliers import fit_bounds
from ratecraft.operators.sketches import bounds_from_sketches, column_sketches, merged, rank_errors, read_parts, sketch_quantiles, write_part
from ratecraft.session import scratch_path

PROBS = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)


def frame(spark, n=20_000, seed=1):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"part": rng.integers(0, 5, n), "normal": rng.normal(size=n), "skewed": np.floor(rng.pareto(0.5, n)),
                        "constant": 7, "sorted": np.arange(n, dtype=float)})
    # the parts are of different kinds
    pdf.loc[pdf.part == 4, "normal"] += 100
    return spark.createDataFrame(pdf).withColumn("none", F.lit(None).cast("double")).withColumn(
        "odd", F.when(F.col("part") == 1, F.lit(float("nan"))).when(F.col("part") == 2, F.lit(None)).otherwise(F.col("sorted")))


COLS = ("normal", "skewed", "constant", "sorted", "none", "odd")


def test_merged_parts_keep_the_rank_error(spark):
    df, path = frame(spark).cache(), scratch_path(spark, "sketches")
    for i in range(5):
        write_part(df.where(F.col("part") == i), COLS, path, f"day-{i}")
    write_part(df.where(F.col("part") == 2), COLS, path, "day-2")          # loaded again: replaced, not added
    sketches = read_parts(spark, path)
    counts = {r.column: r.n for r in sketches.collect()}
    assert counts["normal"] == 20_000 and counts["none"] == 0 and counts["odd"] == df.where("part not in (1, 2)").count()
    errors = rank_errors(df, sketch_quantiles(sketches, PROBS)).collect()
    assert len(errors) == len(COLS) * len(PROBS)
    for r in errors:
        if r.column == "none":
            assert r.value is None and r.rank_error is None
        else:
            assert 0 <= r.rank_error <= 0.01, r
    assert any(r.rank_error > 0 for r in errors if r.column != "none")     # a sketch, not an exact quantile
    assert {r.value for r in errors if r.column == "constant"} == {7.0}


def test_rank_errors_see_a_wrong_quantile(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    wrong = spark.createDataFrame([("x", 0.5, 89.0), ("x", 0.5, 49.0), ("x", 0.5, -1.0)], "column string, p double, value double")
    assert sorted(round(r.rank_error, 9) for r in rank_errors(df, wrong).collect()) == [0.0, 0.39, 0.5]


def test_bounds_without_a_refit(spark):
    df, path = frame(spark).cache(), scratch_path(spark, "sketches")
    for i in range(4):
        write_part(df.where(F.col("part") == i), COLS, path, f"day-{i}")
    before = bounds_from_sketches(read_parts(spark, path), ["normal"], "iqr")
    write_part(df.where(F.col("part") == 4), COLS, path, "day-4")           # a new day
    for method in ("iqr", "clamp95", "clamp5"):
        got, exact = bounds_from_sketches(read_parts(spark, path), COLS, method), fit_bounds(df, COLS, method, rel_error=0.0)
        assert got.method == method and got.columns == list(COLS) and got.center["none"] is None and got.upper["none"] is None
        assert abs(got.center["normal"] - exact.center["normal"]) < 0.05 and abs(got.upper["sorted"] - exact.upper["sorted"]) < 20_000 * 0.03
    assert before.upper != bounds_from_sketches(read_parts(spark, path), ["normal"], "iqr").upper


def test_view_bounds_of_parts_train_the_people_model(spark, features_small):
    from ratecraft.plans import jobs
    from ratecraft.plans.models import small_spec
    from ratecraft.plans.views import VIEWS, add_view_part, fit_view_bounds, view_bounds_of_parts
    path, half = scratch_path(spark, "sketches"), F.pmod(F.col("uid_uid").cast("long"), F.lit(2))
    for i in (0, 1):
        add_view_part(features_small.where(half == i), VIEWS["people"], path, str(i))
    bounds, exact = view_bounds_of_parts(spark, VIEWS["people"], path), fit_view_bounds(features_small, VIEWS["people"])
    assert bounds.method == exact.method and set(bounds.columns) == set(exact.columns)
    trained = jobs.train(features_small, "people", small_spec("people"), bounds=bounds)
    assert trained.bounds == bounds and trained.report["n"] > 0


def test_empty_frame(spark):
    got = sketch_quantiles(merged(column_sketches(frame(spark, 10).where("false"), COLS)), PROBS).collect()
    assert len(got) == len(COLS) * len(PROBS) and all(r.value is None and r.n == 0 for r in got)
