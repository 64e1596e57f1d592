"""Running totals over an ordered key without a single-task window.

A bare ``Window.orderBy(key)`` (no partition) moves every row into one task.
Here rows are range-partitioned by their own key and written with the number of
their partition; running totals are computed inside each partition in parallel,
and each is shifted by the exact total of the partitions before it.  Spark's range
partitioner finds the bounds and a row finds its partition by binary search, so
neither the plan nor the work per row grows with the number of partitions.  That
number is the session's shuffle partitions, which AQE reduces where they are
small.  The result is exact: equal keys always fall in the same partition, so ties
are counted together (RANGE frame semantics).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.sources.writers import stage

SMALL_TABLE = 100_000    # rows of a table of targets, at most, that are broadcast


def range_partitioned(df: DataFrame, group_cols: Sequence[str], order_col: str, descending: bool = False,
                      num_partitions: int | None = None) -> DataFrame:
    """The rows, written by ranges of (group, key), with ``_slice``, the number of their range.

    A range of a later number holds larger (group, key); a hot group is cut by its keys."""
    by = [*map(F.col, group_cols), F.col(order_col).desc() if descending else F.col(order_col).asc()]
    ranged = df.repartitionByRange(num_partitions, *by) if num_partitions else df.repartitionByRange(*by)
    return stage(ranged.withColumn("_slice", F.spark_partition_id()), "ranges")


def cumulative_sums(df: DataFrame, group_cols: Sequence[str], order_col: str,
                    sum_cols: Sequence[str], descending: bool = False,
                    num_partitions: int | None = None, prefix: str = "cum_") -> DataFrame:
    """Add ``<prefix><c>`` = sum of ``c`` over rows of the same group whose
    key is <= (or >= when ``descending``) this row's key.

    Input should hold one row per (group, key) -- e.g. value counts -- so a hot
    key is one row, not a hot range.  ``num_partitions``: of the ranges, the
    session's shuffle partitions when not given.
    """
    parts = [*group_cols, "_slice"]
    rows = range_partitioned(df, group_cols, order_col, descending, num_partitions)
    totals = rows.groupBy(*parts).agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    # one row per group and range
    earlier = ((Window.partitionBy(*group_cols) if group_cols else Window).orderBy("_slice")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*parts, *[F.coalesce(F.sum(f"_tot_{c}").over(earlier), F.lit(0)).alias(f"_off_{c}") for c in sum_cols])
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    within = Window.partitionBy(*parts).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inner = rows.select("*", *[F.sum(c).over(within).alias(f"_in_{c}") for c in sum_cols])
    return inner.join(offsets, parts).select(
        *df.columns, *[(F.col(f"_off_{c}") + F.col(f"_in_{c}")).alias(f"{prefix}{c}") for c in sum_cols])
