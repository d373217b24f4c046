"""Queries for newest-row, type-2 history and movement operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import movements as mv
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.scd2 import apply_snapshot, as_of, current, replay_snapshots
from tidemark.plans.source_tables import (
    PART_MONTH_SNAP_SQL,
    USER_DAY_SNAP_SQL,
    part_month_snapshots,
    part_months,
    table,
    user_day_snapshots,
    user_days,
)


def q_latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's most recent order (tie-break: highest order key)."""
    return latest_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


def q_scd2_replay(spark: SparkSession, d: str) -> DataFrame:
    """D3: full type-2 history of user states over all daily snapshots."""
    return replay_snapshots(user_day_snapshots(spark, d), ["user_id"], ["state"], "period",
                            periods=user_days(spark, d))


def q_scd2_apply(spark: SparkSession, d: str) -> DataFrame:
    """The history of every day but the last, then the last day's snapshot
    applied on top; must equal the full replay."""
    snap = user_day_snapshots(spark, d)
    # The last day: one scalar from two raw columns (a cheap scan, not the
    # deduplicated snapshot), fetched once and used as a literal.
    ev = table(spark, d, "events").where(F.col("user_id").isNotNull())
    last_day = ev.select(F.max(F.date_format("ts", "yyyy-MM-dd"))).first()[0]
    days = user_days(spark, d).where(F.col("period") < last_day)
    before = replay_snapshots(snap.where(F.col("period") < last_day), ["user_id"], ["state"], "period",
                              periods=days)
    latest = snap.where(F.col("period") == last_day)
    return apply_snapshot(before, latest, ["user_id"], ["state"], last_day)


def q_scd2_current(spark: SparkSession, d: str) -> DataFrame:
    """Current version of each user."""
    return current(q_scd2_replay(spark, d))


# Fixed value: the day the as-of query looks at.
AS_OF_DAY = "2024-01-15"


def q_scd2_as_of(spark: SparkSession, d: str) -> DataFrame:
    """P13 (as of a day): each user's version valid on AS_OF_DAY."""
    return as_of(q_scd2_replay(spark, d), AS_OF_DAY)


def q_movements(spark: SparkSession, d: str) -> DataFrame:
    """M4: all hire / transfer / termination events in one pass."""
    return mv.movements(user_day_snapshots(spark, d), ["user_id"], "period", ["state"],
                        periods=user_days(spark, d))


def q_movements_from_history(spark: SparkSession, d: str) -> DataFrame:
    """M4 from type-2 history: the same events, derived from the versions."""
    return mv.movements_from_history(q_scd2_replay(spark, d), ["user_id"], ["state"])


def q_hires(spark, d):
    return mv.hires(q_movements(spark, d))


def q_transfers(spark, d):
    return mv.transfers(q_movements(spark, d))


def q_terminations(spark, d):
    return mv.terminations(q_movements(spark, d))


def q_part_supplier_history(spark: SparkSession, d: str) -> DataFrame:
    """D3 on the largest table: which supplier shipped each part, as type-2 history."""
    return replay_snapshots(part_month_snapshots(spark, d), ["l_partkey"], ["l_suppkey"], "period",
                            periods=part_months(spark, d))


QUERIES = {
    "latest_per_key": q_latest_per_key,
    "part_supplier_history": q_part_supplier_history,
    "scd2_replay": q_scd2_replay,
    "scd2_apply": q_scd2_apply,
    "scd2_current": q_scd2_current,
    "scd2_as_of": q_scd2_as_of,
    "movements": q_movements,
    "movements_from_history": q_movements_from_history,
    "hires": q_hires,
    "transfers": q_transfers,
    "terminations": q_terminations,
}

_REPLAY_SQL = f"""
WITH {USER_DAY_SNAP_SQL},
p AS (SELECT period, row_number() OVER (ORDER BY period) AS idx FROM (SELECT DISTINCT period FROM snap) d),
s AS (SELECT snap.user_id, snap.state, snap.period, p.idx FROM snap JOIN p USING (period)),
f AS (
  SELECT *, CASE WHEN lag(idx) OVER w IS NULL OR lag(idx) OVER w <> idx - 1
                   OR lag(state) OVER w IS DISTINCT FROM state THEN 1 ELSE 0 END AS brk
  FROM s WINDOW w AS (PARTITION BY user_id ORDER BY idx)),
v AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY idx
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ver FROM f),
g AS (SELECT user_id, ver, state, min(idx) AS s_idx, max(idx) AS e_idx
      FROM v GROUP BY user_id, ver, state)
SELECT g.user_id, g.state, ps.period AS __START_AT, pe.period AS __END_AT
FROM g JOIN p ps ON ps.idx = g.s_idx LEFT JOIN p pe ON pe.idx = g.e_idx + 1
"""

_MOVEMENTS_SQL = f"""
WITH {USER_DAY_SNAP_SQL},
h AS (SELECT user_id, period, state,
             lag(period) OVER w AS prev_period, lag(state) OVER w AS prev_state
      FROM snap WINDOW w AS (PARTITION BY user_id ORDER BY period)),
p AS (SELECT period, lead(period) OVER (ORDER BY period) AS next_period
      FROM (SELECT DISTINCT period FROM snap) d)
SELECT user_id, period, 'HIRE' AS event_type, CAST(NULL AS VARCHAR) AS from_state, state
FROM h WHERE prev_period IS NULL
UNION ALL
SELECT user_id, period, 'TRANSFER', prev_state, state
FROM h WHERE prev_period IS NOT NULL AND state <> prev_state
UNION ALL
SELECT c.user_id, p.next_period, 'TERMINATION', c.state, CAST(NULL AS VARCHAR)
FROM snap c JOIN p ON c.period = p.period
WHERE p.next_period IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM snap n WHERE n.user_id = c.user_id AND n.period = p.next_period)
"""

_PART_REPLAY_SQL = f"""
WITH {PART_MONTH_SNAP_SQL},
p AS (SELECT period, row_number() OVER (ORDER BY period) AS idx FROM (SELECT DISTINCT period FROM psnap) d),
s AS (SELECT psnap.l_partkey, psnap.l_suppkey, psnap.period, p.idx FROM psnap JOIN p USING (period)),
f AS (
  SELECT *, CASE WHEN lag(idx) OVER w IS NULL OR lag(idx) OVER w <> idx - 1
                   OR lag(l_suppkey) OVER w IS DISTINCT FROM l_suppkey THEN 1 ELSE 0 END AS brk
  FROM s WINDOW w AS (PARTITION BY l_partkey ORDER BY idx)),
v AS (SELECT *, sum(brk) OVER (PARTITION BY l_partkey ORDER BY idx
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ver FROM f),
g AS (SELECT l_partkey, ver, l_suppkey, min(idx) AS s_idx, max(idx) AS e_idx
      FROM v GROUP BY l_partkey, ver, l_suppkey)
SELECT g.l_partkey, g.l_suppkey, ps.period AS __START_AT, pe.period AS __END_AT
FROM g JOIN p ps ON ps.idx = g.s_idx LEFT JOIN p pe ON pe.idx = g.e_idx + 1
"""

ORACLE = {
    "part_supplier_history": _PART_REPLAY_SQL,
    "latest_per_key": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_custkey IS NOT NULL) t WHERE rn = 1
""",
    "scd2_replay": _REPLAY_SQL,
    "scd2_apply": _REPLAY_SQL,
    "scd2_current": f"SELECT * FROM ({_REPLAY_SQL}) r WHERE __END_AT IS NULL",
    "scd2_as_of": f"""SELECT * FROM ({_REPLAY_SQL}) r
WHERE __START_AT <= '{AS_OF_DAY}' AND (__END_AT IS NULL OR __END_AT > '{AS_OF_DAY}')""",
    "movements": _MOVEMENTS_SQL,
    "movements_from_history": _MOVEMENTS_SQL,
    "hires": f"SELECT * FROM ({_MOVEMENTS_SQL}) m WHERE event_type = 'HIRE'",
    "transfers": f"SELECT * FROM ({_MOVEMENTS_SQL}) m WHERE event_type = 'TRANSFER'",
    "terminations": f"SELECT * FROM ({_MOVEMENTS_SQL}) m WHERE event_type = 'TERMINATION'",
}
