"""Broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint ``broadcast`` when ``df``, a table of a few narrow columns, has at
    most ``max_rows`` rows.

    The check collects at most ``max_rows + 1`` rows; up to the bound these very
    rows are broadcast, so ``df`` is not computed again.  Above it the frame is
    returned unchanged and the planner (AQE included) joins as it sees fit.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
