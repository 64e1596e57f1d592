"""Feature table schema, view shapes, sinks."""

import pytest
from pyspark.sql import functions as F

from ratecraft.plans.features import FEATURE_COLUMNS
from ratecraft.plans.views import VIEWS, build_view, fit_view_bounds
from ratecraft.session import scratch_path
from ratecraft.sources.schemas import feature_schema
from ratecraft.sources.writers import read_scores, write_scores


def test_feature_table_matches_declared_schema(features_small):
    assert len(FEATURE_COLUMNS) == 81
    got = [(f.name, f.dataType.simpleString()) for f in features_small.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in feature_schema().fields]
    assert got == want


def test_feature_table_one_row_per_customer(spark, features_small):
    n = features_small.count()
    assert n == features_small.select("uid_uid").distinct().count()
    assert n == spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count()


@pytest.mark.parametrize("module,n", [("people", 21), ("consume", 29), ("finance", 21),
                                      ("interaction", 8), ("relation", 4)])
def test_view_shapes(features_small, module, n):
    train = build_view(features_small, module, "train")
    bounds = fit_view_bounds(features_small, VIEWS[module])
    pred = build_view(features_small, module, "predict", bounds=bounds)
    assert train.columns[:2] == ["uid_uid", "uid_flag"] and len(train.columns) == n + 2
    assert pred.columns[0] == "uid_uid" and len(pred.columns) == n + 1 + (module == "people")
    if module == "people":
        assert "uid_flag" in pred.columns
        assert "uid_flag" not in build_view(features_small.drop("uid_flag"), module, "predict", bounds=bounds).columns


def test_prediction_never_fits_bounds(features_small):
    with pytest.raises(ValueError):
        build_view(features_small, "people", "predict")
    from ratecraft.plans.views import build_all_views
    with pytest.raises(ValueError):
        build_all_views(features_small, "predict")
    bounds = fit_view_bounds(features_small, VIEWS["people"])
    few = features_small.where("uid_age > 60")
    whole = build_view(features_small, "people", "predict", bounds=bounds)
    part = build_view(few, "people", "predict", bounds=bounds)
    assert part.exceptAll(whole).count() == 0


def test_csv_by_name(spark):
    from ratecraft.plans.jobs import read_features
    from ratecraft.sources.readers import read_csv
    schema = "uid_uid string, a int, b double"
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(schema)
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("x", 1.5, "u1", 7)], "extra string, b double, uid_uid string, a int").write.option("header", True).csv(path)
    got = read_csv(spark, path, schema)
    assert got.columns == ["uid_uid", "a", "b"] and tuple(got.first()) == ("u1", 7, 1.5)
    with pytest.raises(ValueError):
        read_csv(spark, path, StructType.fromDDL("uid_uid string, c int"))
    assert tuple(read_csv(spark, path, StructType.fromDDL("uid_uid string, c int"), optional=("c",)).first()) == ("u1", None)
    assert read_csv(spark, path, StructType.fromDDL("c string"), rename={"extra": "c"}).first().c == "x"
    with pytest.raises(ValueError):
        read_features(spark, path)


def test_missing_and_not_a_number_statistics(spark):
    from ratecraft.operators.outliers import fit_bounds
    from ratecraft.operators.quantiles import quantiles
    nan = float("nan")
    df = spark.createDataFrame([(float(i), None, float(i)) for i in range(10)] + [(nan, None, None)] * 10, "a double, b double, c double")
    for method in ("iqr", "clamp95", "sigma"):
        for error in (0.0, 0.1):
            b = fit_bounds(df, ["a", "b"], method, rel_error=error)
            assert b.center["b"] is None
            if method == "sigma":
                assert b.center["a"] == 4.5
    assert quantiles(df, ["a"], [0.5])["a"] == [4.0] and quantiles(df, ["a"], [0.5], 0.01)["a"] == [4.0]


def test_filled_views_have_no_nulls(features_small):
    for module in ("consume", "finance"):
        v = build_view(features_small, module, "train")
        nulls = v.select(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in VIEWS[module].features]).first()
        assert sum(nulls) == 0


def test_train_view_drops_null_labels(spark):
    df = spark.createDataFrame([("1", None, 5.0), ("2", 1, 7.0)], "uid_uid string, uid_flag int, pro_validpoints double")
    from ratecraft.plans.views import ViewSpec
    spec = ViewSpec("t", ("pro_validpoints",))
    assert [r.uid_uid for r in build_view(df, spec, "train").collect()] == ["2"]


def test_people_clamp_bounds_fit_on_train_rows_only(features_small):
    from ratecraft.plans.views import fit_view_bounds
    b = fit_view_bounds(features_small, VIEWS["people"], rel_error=0.0)
    out = build_view(features_small, "people", "predict", bounds=b)
    for c in VIEWS["people"].clamp:
        mx = out.agg(F.max(f"{c}_new")).first()[0]
        assert mx <= b.upper[c]


def test_score_sink_refuses_existing_path(spark):
    df = spark.createDataFrame([("1", 400.0)], "uid_uid string, ScoreX double")
    path = scratch_path(spark, "sink")
    write_scores(df, path)
    with pytest.raises(Exception):
        write_scores(df, path)
    write_scores(df, path, mode="overwrite")
    assert read_scores(spark, path, "ScoreX").collect()[0].ScoreX == 400.0


def test_staged_and_direct_feature_tables_are_identical(spark, features_small):
    from ratecraft.plans.features import materialize_feature_table
    staged = materialize_feature_table(spark, "/root/testdata/sf0.001", scratch_path(spark, "ft"),
                                       stage_lines=True)
    direct = features_small
    assert staged.exceptAll(direct).count() == 0 and direct.exceptAll(staged).count() == 0


def test_all_views_in_one_projection_equal_separate_views(features_small):
    from ratecraft.plans.views import build_all_views, fit_view_bounds
    b = fit_view_bounds(features_small, VIEWS["people"], rel_error=0.0)
    allv = build_all_views(features_small, "predict", bounds=b, fill_overrides={"consume": 0})
    for m in VIEWS:
        one = build_view(features_small, m, "predict", bounds=b if m == "people" else None,
                         fill_override=0 if m == "consume" else None)
        one = one.drop("uid_flag")     # of the people view; not a feature
        sub = allv.select("uid_uid", f"{m}.*")
        assert sub.columns == one.columns
        assert sub.exceptAll(one).count() == 0 and one.exceptAll(sub).count() == 0
