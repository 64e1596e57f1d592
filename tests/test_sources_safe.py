"""Malformed CSV rows; score tables that are replaced safely and joined without a shuffle."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructType

from ratecraft.operators.combine import WEIGHTS, combine_scores
from ratecraft.session import scratch_path
from ratecraft.sources.readers import RECORD, MalformedRows, read_csv_checked
from ratecraft.sources.score_tables import ScoreTable, bucket_count

SCHEMA = StructType().add("uid_uid", StringType()).add("a", IntegerType()).add("b", DoubleType())


def write_lines(spark, lines):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    return path


def test_rows_that_do_not_fit_are_kept_apart(spark):
    path = write_lines(spark, ["b,user,a,extra", "1.5,u1,7,x", "abc,u2,7,x", "2.5,u3,12x,x", "3.5,u4,8", "4.5,u5,9,x,y", ",u6,,x", '"1.25","u,7","3",x'])
    got = read_csv_checked(spark, path, SCHEMA, rename={"user": "uid_uid"}, max_rejected=0.6)
    assert (got.n_rows, got.n_rejected) == (7, 4)
    assert sorted(map(tuple, got.rows.collect())) == [("u,7", 3, 1.25), ("u1", 7, 1.5), ("u6", None, None)]
    bad = {r.uid_uid: r for r in got.rejected.collect()}
    assert {k: r[RECORD] for k, r in bad.items()} == {"u2": "abc,u2,7,x", "u3": "2.5,u3,12x,x", "u4": "3.5,u4,8", "u5": "4.5,u5,9,x,y"}
    assert bad["u3"].a is None and bad["u3"].b == 2.5
    # a query of one column sees the same rows
    assert sorted(r.b for r in got.rows.select("b").collect() if r.b) == [1.25, 1.5]


def test_too_many_rows_that_do_not_fit_raise(spark):
    path = write_lines(spark, ["uid_uid,a,b", "u1,1,1.0", "u2,12x,1.0"])
    quarantine = scratch_path(spark, "bad")
    with pytest.raises(MalformedRows, match="1 of 2 rows"):
        read_csv_checked(spark, path, SCHEMA, quarantine=quarantine)
    assert spark.read.parquet(quarantine).first()[RECORD] == "u2,12x,1.0"
    assert read_csv_checked(spark, path, SCHEMA, max_rejected=0.5).rows.count() == 1
    assert read_csv_checked(spark, write_lines(spark, ["uid_uid,a,b"]), SCHEMA).n_rows == 0
    with pytest.raises(ValueError, match="lacks"):
        read_csv_checked(spark, write_lines(spark, ["uid_uid,a", "u1,1"]), SCHEMA)


def test_a_malformed_file_does_not_score(spark, features_small):
    from ratecraft.plans import jobs
    path = scratch_path(spark, "csv")
    bad = F.when(F.col("uid_uid") == "1", F.lit("12x")).otherwise(F.col("pro_validpoints").cast("string"))
    features_small.withColumn("pro_validpoints", bad).write.option("header", True).csv(path)
    with pytest.raises(MalformedRows):
        jobs.read_features(spark, path)
    assert jobs.read_features(spark, path, max_rejected=0.01).count() == features_small.count() - 1


def scores(spark, n, offset=0.0, name="ScoreX"):
    return spark.range(n).select(F.col("id").cast("string").alias("uid_uid"), (F.col("id") + offset).cast("double").alias(name))


def test_a_failed_write_leaves_the_old_scores(spark):
    table = ScoreTable(scratch_path(spark, "scores"))
    with pytest.raises(FileNotFoundError):
        table.read(spark)
    table.write(scores(spark, 50))
    with pytest.raises(FileExistsError):
        table.write(scores(spark, 50, 1.0))
    # the write breaks after some rows
    broken = scores(spark, 50, 2.0).withColumn("ScoreX", F.when(F.col("uid_uid") == "49", F.raise_error(F.lit("lost"))).otherwise(F.col("ScoreX")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        table.write(broken, mode="overwrite")
    assert {r.uid_uid: r.ScoreX for r in table.read(spark).collect()} == {str(i): float(i) for i in range(50)}
    old = table.read(spark)
    table.write(scores(spark, 30, 5.0), mode="overwrite")
    assert {r.uid_uid: r.ScoreX for r in table.read(spark).collect()} == {str(i): i + 5.0 for i in range(30)}
    assert old.count() == 50 and len(table.versions(spark)) == 2 and len(table.superseded(spark)) == 1
    with pytest.raises(ValueError):
        table.write(scores(spark, 1), mode="append")


def test_a_session_without_the_catalog_entry_reads_the_buckets(spark):
    table = ScoreTable(scratch_path(spark, "scores"))
    table.write(scores(spark, 100))
    name = table.read(spark)._jdf.queryExecution().analyzed().toString().split("ratecraft_scores_")[1][:24]
    spark.sql(f"DROP TABLE ratecraft_scores_{name}")
    assert table.read(spark).count() == 100
    assert sorted(os.listdir(table.path.removeprefix("file:"))) == ["manifest", "staged", "versions"]


def test_bucket_counts_are_powers_of_two_by_rows():
    assert [bucket_count(n, 10) for n in (0, 80, 81, 160, 161, 1000)] == [8, 8, 16, 16, 32, 128]


def test_combination_does_not_shuffle_by_key(spark):
    names = list(WEIGHTS)
    tables = {c: ScoreTable(scratch_path(spark, "scores")) for c in names}
    for i, c in enumerate(names):
        # the last has fewer customers and fewer buckets
        ScoreTable(tables[c].path, rows_per_bucket=20).write(scores(spark, 400 if i < 4 else 100, float(i), c))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = combine_scores({c: t.read(spark) for c, t in tables.items() if c != names[-1]}, WEIGHTS)
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert len(rows) == 400 and all(r[names[1]] == r[names[0]] + 1 for r in rows)
        assert combine_scores({c: t.read(spark) for c, t in tables.items()}, WEIGHTS).count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
