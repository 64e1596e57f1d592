"""Scans (S1-S4): CSV, JSON lines, Parquet, catalog table, and a source profile."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecraft.session import scratch_path
from ratecraft.sources.writers import stage

RECORD = "_malformed_record"     # the text of a row that does not fit the schema


def _file_schema(spark: SparkSession, path: str, schema: T.StructType, rename: dict[str, str],
                 optional: Sequence[str]) -> tuple[T.StructType, list]:
    """The file's columns in its order with the schema's types; the schema's columns as expressions over them."""
    names = spark.read.option("header", True).csv(path).columns
    types = {f.name: f.dataType for f in schema.fields}
    missing = [c for c in types if c not in {rename.get(n, n) for n in names} and c not in optional]
    if missing:
        raise ValueError(f"{path}: the header lacks {missing}")
    of = {rename.get(n, n): n for n in names}
    columns = [F.col(f"`{of[c]}`").alias(c) if c in of else F.lit(None).cast(t).alias(c) for c, t in types.items()]
    return T.StructType([T.StructField(n, types.get(rename.get(n, n), T.StringType())) for n in names]), columns


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             header: bool = True, rename: dict[str, str] | None = None,
             optional: Sequence[str] = ()) -> DataFrame:
    """S1.  With a schema, columns are found by their name in the header, in
    whatever order they stand: the result has the schema's columns in its order.
    Extra columns are ignored, a missing one raises, except that ``optional``
    ones come back NULL.  ``rename`` maps names in the file to the schema's.
    Types are never inferred (only the header line is read beforehand), and part
    files whose header differs from the first one's raise.

    Without a schema Spark infers types, as the original application did;
    without a header columns go by position."""
    if schema is None:
        return spark.read.option("header", header).option("inferSchema", True).csv(path)
    if not header:
        return spark.read.schema(schema).csv(path)
    in_file, columns = _file_schema(spark, path, schema, rename or {}, optional)
    return spark.read.option("header", True).option("enforceSchema", False).schema(in_file).csv(path).select(*columns)


class MalformedRows(ValueError):
    """More rows of a file do not fit its schema than the reader was told to accept."""


@dataclass(frozen=True)
class CheckedRows:
    """A file's rows that fit the schema, and those that do not: their text and what of them could be read."""

    rows: DataFrame
    rejected: DataFrame      # the schema's columns (NULL where a cell does not fit) and the record's text
    n_rows: int
    n_rejected: int


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, rename: dict[str, str] | None = None,
                     optional: Sequence[str] = (), max_rejected: float = 0.0, quarantine: str | None = None) -> CheckedRows:
    """S1 with a channel for rows that do not fit: a cell that is not of its
    column's type, too few or too many cells.

    Such rows never reach ``rows`` with NULLs in place of the cells.  They are
    written to ``quarantine`` (a new folder of the shared one when not given) and,
    if they are more than ``max_rejected`` of all rows (a share; none by default),
    :class:`MalformedRows` is raised and names that folder.  The file is parsed
    once, whole rows at a time, and written: a scan that read some columns alone
    would not see what is wrong with the others."""
    in_file, columns = _file_schema(spark, path, schema, rename or {}, optional)
    parsed = (spark.read.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE").option("columnPruning", False)
              .option("columnNameOfCorruptRecord", RECORD).schema(in_file.add(RECORD, T.StringType())).csv(path))
    every = stage(parsed.select(*columns, RECORD), "csv")
    bad = F.col(RECORD).isNotNull()
    n, rejected = every.agg(F.count(F.lit(1)), F.count(RECORD)).first()
    where = quarantine or scratch_path(spark, "quarantine")
    if rejected:
        every.where(bad).write.parquet(where)
    if rejected > max_rejected * n:
        raise MalformedRows(f"{path}: {rejected} of {n} rows do not fit the schema; they are in {where}")
    kept = spark.read.schema(every.schema).parquet(where) if rejected else every.where(bad)
    return CheckedRows(every.where(~bad).drop(RECORD), kept, n, rejected)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S3: a catalog table or temp view, ``SELECT *`` of the *named* table."""
    return spark.table(name)


def profile(df: DataFrame) -> DataFrame:
    """One-row profile (row count, column count) computed in one job."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).alias("n_columns"))


def preview(df: DataFrame, n: int = 5, order_by: str | None = None) -> DataFrame:
    """L1: first ``n`` rows (ordered when a key is given, for determinism).
    The ordered form is a top-n (TakeOrderedAndProject), not a global sort."""
    if order_by is not None:
        df = df.orderBy(order_by)
    return df.limit(n)
