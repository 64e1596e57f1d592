"""Driver-provided parquet tables (one file or folder per table).

Scans declare the schema of the columns the application reads: no footer
pass for schema inference, and a scan never reads a column it does not need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)
FEATURE_TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_L, _I, _D, _S, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Columns (and types) the feature table reads from each driver table.
SCHEMAS = {
    "nation": _schema(("n_nationkey", _I), ("n_regionkey", _I)),
    "customer": _schema(("c_custkey", _L), ("c_nationkey", _I), ("c_acctbal", _D)),
    "supplier": _schema(("s_suppkey", _L), ("s_nationkey", _I)),
    "part": _schema(("p_partkey", _L), ("p_type", _S), ("p_size", _I)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_orderdate", _TS)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L),
                        ("l_extendedprice", _D), ("l_discount", _D), ("l_returnflag", _S),
                        ("l_shipdate", _TS)),
    "events": _schema(("user_id", _L), ("ts", _TS), ("event_type", _S), ("value", _D)),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    r = spark.read
    if name in SCHEMAS:
        r = r.schema(SCHEMAS[name])
    return r.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_tables(spark: SparkSession, sf_dir: str, names=FEATURE_TABLES) -> dict[str, DataFrame]:
    return {n: table(spark, sf_dir, n) for n in names}
