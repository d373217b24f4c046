"""Headcount anomaly gate (V1; G3, G5, W5).

For every period: distinct active keys, the mean of the (up to) three most
recent earlier periods that had any active key, the percent variance and a
strict ``>`` threshold test. Periods with no active key count 0 but are
left out of later means. The per-period table is tiny (one row per period),
so the trailing windows over it run in one task by design.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.periods import normalize_period

DEFAULT_THRESHOLD_PCT = 10.0


class HeadcountAnomaly(Exception):
    pass


def headcount_by_period(df: DataFrame, key: str, period_col: str = "period",
                        active: Column | None = None) -> DataFrame:
    """Distinct active keys per period; 0 for a period with rows but none active."""
    marked = df.select(period_col, F.when(active, F.col(key)).alias("_k") if active is not None
                       else F.col(key).alias("_k"))
    return marked.groupBy(period_col).agg(F.count_distinct("_k").alias("headcount"))


def headcount_gate(df: DataFrame, key: str, period_col: str = "period",
                   active: Column | None = None, threshold_pct: float = DEFAULT_THRESHOLD_PCT,
                   lookback: int = 3) -> DataFrame:
    """Columns: period, headcount, rolling_avg, variance_pct, is_anomaly.

    One pass over the per-period counts, no self join: ``_n`` numbers the
    non-zero periods in order; a range frame over ``_n`` then picks the last
    ``lookback`` non-zero periods before each row (``[-lookback, -1]`` for a
    non-zero row, ``[-(lookback-1), 0]`` for a zero row, whose ``_n`` is
    that of the last non-zero period before it).
    """
    return gate_of_counts(headcount_by_period(df, key, period_col, active), period_col, threshold_pct, lookback)


def gate_of_counts(h: DataFrame, period_col: str = "period", threshold_pct: float = DEFAULT_THRESHOLD_PCT,
                   lookback: int = 3) -> DataFrame:
    """The gate over (period, headcount) rows, one per period."""
    nz = F.when(F.col("headcount") > 0, F.col("headcount"))
    n = F.sum(F.when(F.col("headcount") > 0, 1).otherwise(0)).over(
        Window.orderBy(period_col).rowsBetween(Window.unboundedPreceding, 0))
    by_n = Window.orderBy("_n")
    before_nonzero = F.avg("_nz").over(by_n.rangeBetween(-lookback, -1))
    before_zero = F.avg("_nz").over(by_n.rangeBetween(-(lookback - 1), 0))
    out = (h.withColumn("_nz", nz).withColumn("_n", n)
           .select(period_col, "headcount",
                   F.when(F.col("_nz").isNotNull(), before_nonzero).otherwise(before_zero)
                   .alias("rolling_avg")))
    var = F.abs(F.col("headcount") - F.col("rolling_avg")) / F.col("rolling_avg") * 100
    out = out.withColumn("variance_pct", F.when(F.col("rolling_avg") > 0, var))
    return out.withColumn(
        "is_anomaly", F.coalesce(F.col("variance_pct") > F.lit(float(threshold_pct)), F.lit(False)))


def assert_no_anomaly(gate: DataFrame, period: str, period_col: str = "period") -> dict:
    """Raise ``HeadcountAnomaly`` if ``period`` is flagged; return its row.

    A period typed as ``2025-1`` is read as ``2025-01``."""
    period = normalize_period(period)
    rows = gate.where(F.col(period_col) == period).collect()
    if not rows:
        raise HeadcountAnomaly(f"no headcount rows for period {period}")
    r = rows[0].asDict()
    if r["is_anomaly"]:
        raise HeadcountAnomaly(
            f"headcount variance {r['variance_pct']:.1f}% exceeds threshold; "
            f"current {r['headcount']}, rolling avg {r['rolling_avg']:.1f}, period {period}")
    return r
