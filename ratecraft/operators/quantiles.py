"""Multi-column quantiles (A4) in one pass.

* ``approx_quantiles``: Spark's Greenwald-Khanna sketch (``approxQuantile``),
  bounded memory, one job for all columns; rank error <= rel_error * n.
* ``exact_quantiles``: SQL-standard PERCENTILE_DISC (smallest value whose
  cumulative share is >= p), computed distributed: value counts per column
  (map-side combined), running counts by :func:`cumulative_sums`, then the
  first value reaching rank ceil(p * n).  No task ever holds a whole column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.operators.broadcast import checked_broadcast
from ratecraft.operators.cumulative import SMALL_TABLE, cumulative_sums
from ratecraft.sources.writers import stage


def long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value double) for every cell of ``cols`` that is neither NULL nor NaN."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                      for c in cols])
    return df.select(F.inline(cells)).where(
        F.col("value").isNotNull() & ~F.isnan("value"))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n): one row per distinct non-null value of each column
    (map-side combined, so a value held by a third of the rows is one row)."""
    return long_values(df, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    counts: DataFrame | None = None) -> DataFrame:
    """(column, p, value) with PERCENTILE_DISC semantics.  ``counts``: the
    already computed :func:`value_counts` of ``df``, written or persisted."""
    if counts is None:
        counts = stage(value_counts(df, cols), "value-counts")
    cum = cumulative_sums(counts, ["column"], "value", ["n"])
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    targets = totals.select(
        "column", F.inline(F.array(*[F.struct(F.lit(float(p)).alias("p")) for p in probs])), "total")
    targets = targets.select("column", "p", F.greatest(F.ceil(F.col("p") * F.col("total")),
                                                       F.lit(1)).alias("rank"))
    hit = cum.join(checked_broadcast(targets, SMALL_TABLE), "column").where(F.col("cum_n") >= F.col("rank"))
    return hit.groupBy("column", "p").agg(F.min("value").alias("value"))


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     rel_error: float) -> dict[str, list[float]]:
    """Column -> quantile values, one GK-sketch job for all columns; NULL and
    NaN are left out, a column without other values has None for every p."""
    casted = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in cols])
    res = casted.approxQuantile(list(cols), list(probs), rel_error)
    return {c: list(r) or [None] * len(probs) for c, r in zip(cols, res)}


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              rel_error: float = 0.0) -> dict[str, list[float]]:
    """Column -> [quantile per p]; exact when ``rel_error == 0``.

    The result is ``len(cols) * len(probs)`` numbers, collected to the driver."""
    if rel_error > 0:
        return approx_quantiles(df, cols, probs, rel_error)
    rows = exact_quantiles(df, cols, probs).collect()
    got = {(r["column"], r["p"]): r["value"] for r in rows}
    return {c: [got.get((c, float(p))) for p in probs] for c in cols}
