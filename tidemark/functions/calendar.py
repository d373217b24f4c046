"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fiscal_year(d, start_month: int = 10) -> Column:
    """Fiscal year named by the calendar year it ends in."""
    d = _col(d)
    if start_month == 1:
        return F.year(d)
    return F.year(d) + F.when(F.month(d) >= start_month, 1).otherwise(0)


def fiscal_period(d, start_month: int = 10) -> Column:
    """1 for the fiscal year's first month … 12 for its last."""
    return F.pmod(F.month(_col(d)) - start_month, F.lit(12)) + 1


def calendar_columns(d, start_month: int = 10) -> list[Column]:
    d = _col(d)
    return [
        F.date_format(d, "yyyyMMdd").alias("date_id"),
        F.date_format(d, "yyyy-MM-dd").alias("calendar_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        fiscal_year(d, start_month).alias("fiscal_year"),
        fiscal_period(d, start_month).alias("fiscal_period"),
        (F.weekday(d) < 5).alias("is_working_day"),
        F.date_format(d, "EEEE").alias("day_of_week"),
    ]
