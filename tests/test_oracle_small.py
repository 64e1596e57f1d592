"""The driver's correctness gate in miniature: Spark query vs its DuckDB oracle
at sf0.001 for the relational queries (values, names, types, row counts)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
NAMES = ["feature_table", "consume_view_train", "consume_view_predict", "finance_view_train",
         "people_view_train", "people_view_predict", "relation_view", "interaction_view",
         "outlier_iqr_rows", "outlier_sigma", "quantiles_exact", "threshold_curve", "auc_roc",
         "auc_pr", "label_index", "minmax_scaled", "combine_scores", "concat_positional",
         "describe_scores", "hash_split_counts"]
DUCK2SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
              "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return repr(v)


def _rows(cols, rows, order):
    idx = [cols.index(c) for c in order]
    return sorted("|".join(_norm(r[i]) for i in idx) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    scols = [(f.name, f.dataType.simpleString()) for f in sdf.schema.fields]
    res = con.execute(entry.oracle_sql()[name])
    dcols = [(d[0], DUCK2SPARK.get(str(d[1]), str(d[1]))) for d in res.description]
    assert sorted(scols) == sorted(dcols)
    order = sorted(c for c, _ in scols)
    srows = [tuple(r) for r in sdf.collect()]
    drows = res.fetchall()
    assert _rows([c for c, _ in scols], srows, order) == _rows([c for c, _ in dcols], drows, order)
