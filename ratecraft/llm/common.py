"""Helpers shared by the operators of this subpackage.

Lineage is cut by ``materialise``: the rows are written to the folder of
``spark.checkpoint.dir`` and read back, so a lost executor costs only the task
it ran.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
WHITE_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write the rows below the shared folder and read them back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def digest(col: Column) -> tuple[Column, Column]:
    """128 bits of a value as two longs; NULL has a digest of its own."""
    present = F.coalesce(col, F.lit(""))
    return (F.xxhash64(F.lit(1), col.isNull(), present), F.xxhash64(F.lit(2), col.isNull(), present))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def parallelism(spark: SparkSession) -> int:
    """Shuffle partitions of the session, the unit in which work is dealt out."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary; the folder is a parameter (PUBLIC_TOKENIZERS), else the installed package's."""
    folder = os.environ.get("PUBLIC_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
