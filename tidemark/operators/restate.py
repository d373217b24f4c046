"""Restatement of past periods (R1) and its audit row (R2).

``restate`` replaces, for every key present in ``corrections``, all of that
key's rows in the period range by the corrections' rows; everything else is
kept. Rows outside the range pass through; only those inside meet the keys, in
one anti join. The base is never overwritten in place: write the result to a
new location.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dedup import latest_per_key


def restate(base: DataFrame, corrections: DataFrame, keys: Sequence[str], period_col: str,
            start: str, end: str, row_keys: Sequence[str] | None = None,
            ingested_col: str | None = None) -> DataFrame:
    """Raises ValueError for a range that ends before it starts."""
    check_range(start, end)
    keys = list(keys)
    in_range = (F.col(period_col) >= start) & (F.col(period_col) <= end)
    new = corrections.where(in_range)
    if row_keys and ingested_col:
        new = latest_per_key(new, row_keys, [ingested_col])
    scope = new.select(*keys).distinct()
    outside = base.where(~F.coalesce(in_range, F.lit(False)))
    inside = base.where(in_range).join(scope, keys, "left_anti").select(*base.columns)
    return outside.unionByName(inside).unionByName(new.select(*base.columns))


def check_range(start: str, end: str) -> None:
    if start > end:
        raise ValueError(f"Parameter validation failed: start_period {start} is after end_period {end}")


AUDIT_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in (
    "restatement_id", "employee_id", "start_period", "end_period", "triggered_by",
    "triggered_at", "status")] + [T.StructField("rows_removed", T.LongType(), True),
                                  T.StructField("rows_added", T.LongType(), True)])


def audit_row(spark: SparkSession, key: str, start_period: str, end_period: str,
              triggered_by: str, status: str = "SUCCESS", rows_removed: int | None = None,
              rows_added: int | None = None) -> DataFrame:
    """R2: one audit row; every parameter is required."""
    missing = [n for n, v in (("employee_id", key), ("start_period", start_period),
                              ("end_period", end_period), ("triggered_by", triggered_by)) if not v]
    if missing:
        raise ValueError("Parameter validation failed: " + ", ".join(f"{m} is required"
                                                                     for m in missing))
    now = _dt.datetime.now(_dt.timezone.utc)
    row = (uuid.uuid4().hex, key, start_period, end_period, triggered_by, now.isoformat(), status,
           rows_removed, rows_added)
    return spark.createDataFrame([row], AUDIT_SCHEMA)
