"""The ordered sequence of periods present in a snapshot table.

Snapshot operators need, for every period, its position and its neighbours
among the periods that exist. That table has one row per distinct period: a
distinct over one column (partial aggregate on the map side, skew-safe) and an
unpartitioned window over those few rows. It is taken from the raw period
column where the caller gives it, never from a deduplicated snapshot, and no
job runs while the plan is built.

A period names a month or a day, so the table has at most 366 rows for each
year that the data covers; that bound is why it is marked for broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def period_sequence(df: DataFrame, period_col: str) -> DataFrame:
    """Columns: ``period_col``, ``_idx`` (1-based), ``_prev``, ``_next``."""
    w = Window.orderBy(period_col)
    return F.broadcast(
        df.select(period_col).where(F.col(period_col).isNotNull()).distinct()
        .select(
            period_col,
            F.row_number().over(w).alias("_idx"),
            F.lag(period_col).over(w).alias("_prev"),
            F.lead(period_col).over(w).alias("_next"),
        )
    )
