"""Hand-made edge rows for the scalar rules (FIXTURES section 5)."""

from pyspark.sql import functions as F

from ratecraft.functions.expressions import (
    age_fill_flag, age_rule, fill_flag, hash_split_bucket, is_train_row, safe_ratio,
    score_from_probability)
from ratecraft.plans.views import VIEWS


def test_age_rule_and_flag(spark):
    df = spark.createDataFrame([(11,), (12,), (65,), (66,), (0,), (-1,), (None,)], "uid_age int")
    rows = df.select(age_rule("uid_age").alias("a"), age_fill_flag("uid_age").alias("f")).collect()
    assert [r.a for r in rows] == [34.0, 12.0, 65.0, 34.0, 34.0, 34.0, None]
    assert [r.f for r in rows] == [1, 1, 1, 1, 0, 0, None]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(10.0, 4), (10.0, 0), (None, 2), (0.0, 5)], "a double, b bigint")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [2.5, None, None, 0.0]


def test_ratio_then_fill(spark):
    df = spark.createDataFrame([(10.0, 0)], "ord_success_order_amount double, ord_success_order_count bigint")
    spec = VIEWS["consume"]
    out = df.select(spec.derived()["ord_success_order_price"].alias("p"))
    assert out.na.fill(-1.0).first().p == -1.0
    assert out.na.fill(0).first().p == 0.0


def test_balance_counts_wallet_twice(spark):
    df = spark.createDataFrame([(5.0, 2.0), (None, 2.0)], "cap_tmoney_balance double, cap_wallet_balance double")
    expr = VIEWS["finance"].derived()["cap_balance"]
    vals = [r[0] for r in df.select(expr).collect()]
    assert vals == [9.0, None]
    assert [r[0] for r in df.select(expr.alias("b")).na.fill(0).collect()] == [9.0, 0.0]


def test_fill_flag_null_guard(spark):
    df = spark.createDataFrame([(-1,), (3,), (None,)], "x int")
    assert [r[0] for r in df.select(fill_flag("x")).collect()] == [0, 1, None]


def test_score_map(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "p double")
    assert [r[0] for r in df.select(score_from_probability("p")).collect()] == [350.0, 600.0, 850.0]


def test_hash_split_is_stable_and_a_partition(spark):
    df = spark.range(0, 2000).select(F.col("id").cast("string").alias("uid_uid"))
    a = {r.uid_uid: r.t for r in df.select("uid_uid", is_train_row().alias("t")).collect()}
    b = {r.uid_uid: r.t for r in df.repartition(7).select("uid_uid", is_train_row().alias("t")).collect()}
    assert a == b
    buckets = {r[0] for r in df.select(hash_split_bucket()).collect()}
    assert buckets <= set(range(10))
    share = sum(a.values()) / len(a)
    assert 0.6 < share < 0.8
