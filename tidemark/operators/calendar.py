"""Date dimension (D1a): one row per day between two dates.

Days are generated one month per row first, and the months are spread over
the cluster before each expands to its days, so no single task builds the
whole calendar.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.calendar import calendar_columns


def _days(bounds: DataFrame, start: Column, end: Column, fiscal_start_month: int) -> DataFrame:
    months = bounds.select(
        F.explode(F.sequence(F.trunc(start, "month"), F.trunc(end, "month"),
                             F.expr("INTERVAL 1 MONTH"))).alias("_m"),
        start.alias("_lo"), end.alias("_hi"))
    months = months.repartition(F.col("_m"))
    days = months.select(
        F.explode(F.sequence(F.greatest("_m", "_lo"),
                             F.least(F.last_day("_m"), "_hi"))).alias("_d"))
    return days.select(*calendar_columns(F.col("_d"), fiscal_start_month))


def dim_date(spark: SparkSession, start: _dt.date | str = "2018-01-01",
             end: _dt.date | str = "2030-12-31", fiscal_start_month: int = 10) -> DataFrame:
    """Calendar between fixed dates (the reference's 2018-2030 by default)."""
    one = spark.range(1).select(F.to_date(F.lit(str(start))).alias("_s"),
                                F.to_date(F.lit(str(end))).alias("_e"))
    return _days(one, F.col("_s"), F.col("_e"), fiscal_start_month)


def dim_date_covering(df: DataFrame, date_col: str, fiscal_start_month: int = 10) -> DataFrame:
    """Calendar spanning the first to the last date found in ``df[date_col]``."""
    bounds = df.agg(F.min(F.to_date(date_col)).alias("_s"), F.max(F.to_date(date_col)).alias("_e"))
    return _days(bounds.where(F.col("_s").isNotNull()), F.col("_s"), F.col("_e"),
                 fiscal_start_month)
