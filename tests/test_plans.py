"""Plan guards: no registered relational query plans a cross join or a
nested-loop join, views prune columns and push filters into the scan."""

import pytest

from ratecraft.plans.features import feature_table, materialize_feature_table
from ratecraft.plans.queries import QUERIES
from ratecraft.plans.views import build_view
from ratecraft.session import scratch_path

SF = "/root/testdata/sf0.001"
MODEL_QUERIES = {"consume_train_predict", "finance_train_predict", "interaction_train_predict",
                 "people_train_predict", "relation_train_predict", "rf_regression", "rf_regression_sides",
                 "gbt_regression", "combined_model_scores", "train_predict_paths"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODEL_QUERIES))
def test_no_cross_or_nested_loop_join(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name} plans a {bad}"


def test_unread_distinct_counts_are_not_planned(spark):
    from ratecraft.plans.queries import q_label_double
    other = "/root/testdata/sf0.01"      # not the one that the session may hold in its cache
    assert _plan(q_label_double(spark, other)).count("/lineitem.parquet") == 1
    assert _plan(feature_table(spark, other)).count("/lineitem.parquet") == 2


def test_a_view_of_distinct_counts_reads_the_lines_once(spark):
    """It read them twice: the other branch was there for its keys alone."""
    from ratecraft.plans.queries import q_relation_view
    plan = _plan(q_relation_view(spark, "/root/testdata/sf0.01"))
    assert plan.count("/lineitem.parquet") == 1
    assert "Expand" not in plan              # no row of all counted columns per value


def test_distinct_counts_of_a_hot_customer(spark):
    """Exact, and its values are dealt over several tasks; others leave few rows to add up."""
    from pyspark.sql import functions as F

    from ratecraft.plans.features import SLICES, line_distinct_counts
    n = F.col("id")
    lines = spark.range(6_000).select(
        F.when(n % 3 == 0, 0).otherwise(n % 50).alias("k"), (n % 1_000).alias("ok"), (n % 211).alias("sk"), (n * 7 % 1_999).alias("pk"),
        (n % 25).cast("int").alias("city"), F.when(n % 4 == 0, "F").when(n % 4 == 1, "P").alias("st"),
        F.when(n % 7 == 0, "flt").otherwise("htl").alias("lob"))
    count = {"_n_orders": "ok", "ord_success_order_cmobile_count": "if(st = 'F', sk, null)", "com_mobile_count": "sk",
             "com_passenger_count": "pk", "com_idno_count": "city", "ord_success_order_acity_count": "if(st = 'F', city, null)",
             "ord_success_flt_order_acity_count": "if(st = 'F' and lob = 'flt', city, null)"}
    want = lines.groupBy("k").agg(*[F.expr(f"count(DISTINCT {e})").alias(c) for c, e in count.items()])
    got = line_distinct_counts(lines, 30)
    assert got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == want.count()
    assert "hashpartitioning(k#" in _plan(got) and ", slice#" in _plan(got) and SLICES > 1


def test_view_prunes_columns_and_pushes_filters(spark):
    ft = materialize_feature_table(spark, SF, scratch_path(spark, "ft"))
    df = build_view(ft, "relation", "train").where("uid_uid = '7'")
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    assert "PushedFilters: [IsNotNull(uid_uid), IsNotNull(uid_flag), EqualTo(uid_uid,7)]" in plan
    read = plan[plan.index("ReadSchema: struct<") + len("ReadSchema: struct<"):].split(">")[0]
    assert sorted(f.split(":")[0] for f in read.split(",")) == sorted(
        ["uid_uid", "uid_flag", "com_passenger_count", "com_idno_count", "com_mobile_count",
         "ord_success_order_cmobile_count"])


def test_train_predict_evaluates_the_held_out_rows(spark, monkeypatch):
    from ratecraft.plans import queries
    trained, train = [], queries.jobs.train
    monkeypatch.setattr(queries.jobs, "train", lambda *a, **k: trained.append(train(*a, **k)) or trained[-1])
    out = queries.QUERIES["relation_train_predict"](spark, "/root/testdata/sf0.001")
    report, n = trained[0].report, out.where("label is not null and not is_train").count()
    assert n > 0 and report["n"] + report["n_excluded"] == n
    # the counts and the agreement are values of the result, so a report that is wrong shows
    right = out.select("n_evaluated", "n_excluded", "report_agrees").distinct().collect()
    assert [tuple(r) for r in right] == [(n, 0, True)]
    for wrong in ({"n": report["n"] - 1}, {"auc_roc": 0.123}, {"auc_pr": None}, {"accuracy": report["accuracy"] + 1e-6}):
        monkeypatch.setattr(queries.jobs, "train", lambda *a, wrong=wrong, **k: (t := train(*a, **k)).report.update(wrong) or t)
        shown = queries.QUERIES["relation_train_predict"](spark, "/root/testdata/sf0.001").select("n_evaluated", "report_agrees").distinct().collect()
        assert [tuple(r) for r in shown] == [(n - 1, True) if "n" in wrong else (n, False)]
