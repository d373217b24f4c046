"""Queries for what the HR chain does between runs (T3, D2-D3 from a period on,
D6 with re-sent files, Q2 with CRITICAL suppression, R1 downstream, S10).

Batches, files and bad rows are derived from the given tables by fixed rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.periods import period_of
from tidemark.operators import quality as dq
from tidemark.operators.calendar import dim_date_covering
from tidemark.operators.scd2 import replay_from, replay_snapshots
from tidemark.plans.fact_queries import ORACLE as FACT_ORACLE
from tidemark.plans.history_queries import ORACLE as HISTORY_ORACLE
from tidemark.plans.hr import fact_payroll
from tidemark.plans.quality_queries import ORACLE as QUALITY_ORACLE
from tidemark.plans.quality_queries import q_restate
from tidemark.plans.source_tables import table, user_day_snapshots, user_days
from tidemark.session import scratch_dir
from tidemark.sources.landing import export_by_period
from tidemark.sources.rules import Rule
from tidemark.sources.tables import append_once, write_new
from tidemark.streaming.history import maintain_dimension, stored_dimension

# Of ten users, the one whose first snapshots were wrong; of ten
# parts, the one whose key is lost; of five orders, the one whose file was sent
# twice.
WRONG_USERS, LOST_PARTS, RESENT_ORDERS = 10, 10, 5


def q_scd2_late_correction(spark: SparkSession, d: str) -> DataFrame:
    """History stored from a first batch that lacks a day and has wrong states
    on the next one, then replayed from that day when the right files land;
    equals the replay of everything."""
    snap = user_day_snapshots(spark, d)
    days = user_days(spark, d)
    last = [r[0] for r in days.distinct().orderBy(F.desc("period")).limit(3).collect()]
    if len(last) < 3:
        return replay_snapshots(snap, ["user_id"], ["state"], "period", periods=days)
    wrong, late, before = last
    first = snap.where(F.col("period") != late).withColumn("state", F.when(
        (F.col("period") == wrong) & (F.col("user_id") % WRONG_USERS == 0), F.lit("wrong")).otherwise(F.col("state")))
    stored = write_new(replay_snapshots(first, ["user_id"], ["state"], "period",
                                        periods=days.where(F.col("period") != late)),
                       scratch_dir(spark, "late"))
    return replay_from(spark.read.parquet(stored), snap, ["user_id"], ["state"], "period", late, before,
                       periods=days)


def q_scd2_stream(spark: SparkSession, d: str) -> DataFrame:
    """Daily files land in three runs, one day in two parts, one day late,
    one day with wrong states and a corrected file; the stream's state keeps the
    history, which equals the replay of everything."""
    root = scratch_dir(spark, "stream")
    snap = user_day_snapshots(spark, d)
    days = [r[0] for r in user_days(spark, d).distinct().orderBy("period").collect()]
    late, wrong, split = (days[i % len(days)] for i in (len(days) // 3, len(days) // 2, -1))
    bad = F.col("user_id") % WRONG_USERS == 0
    even = F.col("user_id") % 2 == 0
    first = snap.where((F.col("period") != late) & ~((F.col("period") == split) & ~even)).withColumn("state", F.when(
        (F.col("period") == wrong) & bad, F.lit("wrong")).otherwise(F.col("state")))
    lands = [first, snap.where((F.col("period") == late) | ((F.col("period") == wrong) & bad)), snap.where((F.col("period") == split) & ~even)]
    for i, rows in enumerate(lands):
        text = rows.select(F.col("user_id").cast("string").alias("user_id"), "state", "period")
        export_by_period(text, f"{root}/landing", f"part-{i}")
        maintain_dimension(spark, f"{root}/landing", "users", f"{root}/dim", f"{root}/checkpoint", ["user_id"], ["state"],
                           layout="{base}/part-*/*/", buckets=16, fields=["user_id", "state"])
    return stored_dimension(spark, f"{root}/dim").withColumn("user_id", F.col("user_id").cast("long"))


def q_payroll_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines as text with cents, some malformed, several per key; some keys
    in an older and a newer file, of which the newest with valid lines counts."""
    li = table(spark, d, "lineitem")
    line = li.select(F.col("l_orderkey").cast("string").alias("employee_id"), period_of("l_shipdate").alias("period"),
                     F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), "l_linenumber", "l_orderkey")
    amount = F.when(F.col("l_linenumber") == 2, F.lit("n/a")).otherwise(F.col("price").cast("string"))
    newer = line.select("employee_id", "period", amount.alias("gross_pay"), F.lit("0").alias("deductions"),
                        amount.alias("net_pay"), F.lit(2).alias("sent"))
    old = (F.col("price") + 1).cast("string")
    older = line.where(F.col("l_orderkey") % RESENT_ORDERS == 0).select(
        "employee_id", "period", old.alias("gross_pay"), F.lit("0").alias("deductions"), old.alias("net_pay"),
        F.lit(1).alias("sent"))
    files = newer.unionByName(older)
    bronze = files.select("employee_id", "period", "gross_pay", "deductions", "net_pay",
                          F.timestamp_seconds("sent").alias("_file_modified_at"),
                          F.timestamp_seconds(F.lit(9)).alias("_ingested_at"),
                          F.concat(F.lit("file-"), "sent").alias("_source_file_name"))
    people = table(spark, d, "orders").where("o_orderpriority <> '5-LOW'").select(
        F.col("o_orderkey").cast("string").alias("employee_id"))
    return fact_payroll(bronze, people).select("employee_id", "period", F.col("gross_pay").cast("string").alias("gross_pay"),
                                               F.col("net_pay").cast("string").alias("net_pay"), "_source_file_name")


PART_RULES = [
    Rule("p_partkey", "p_partkey IS NOT NULL", "CRITICAL"),
    Rule("p_size", "p_size > 5", "ERROR"),
    Rule("p_retailprice", "p_retailprice > 1000", "WARNING"),
]


def q_dq_critical(spark: SparkSession, d: str) -> DataFrame:
    """Q2: rows that lost their key get their CRITICAL entry and no other."""
    parts = table(spark, d, "part").withColumn("p_partkey", F.when(
        F.col("p_partkey") % LOST_PARTS != 0, F.col("p_partkey")))
    return dq.quality_log(parts, "part", PART_RULES, key="p_name")


def q_restated_headcount(spark: SparkSession, d: str) -> DataFrame:
    """R1 downstream: customers by month after the restatement."""
    return q_restate(spark, d).groupBy("period").agg(F.countDistinct("o_custkey").alias("headcount"))


def q_calendar_once(spark: SparkSession, d: str) -> DataFrame:
    """The calendar appended twice is there once."""
    path = f"{scratch_dir(spark, 'calendar')}/dim_date"
    for _ in range(2):
        append_once(dim_date_covering(table(spark, d, "orders"), "o_orderdate"), path, ["date_id"])
    return spark.read.parquet(path)


QUERIES = {
    "scd2_late_correction": q_scd2_late_correction,
    "scd2_stream": q_scd2_stream,
    "payroll_lines": q_payroll_lines,
    "dq_critical": q_dq_critical,
    "restated_headcount": q_restated_headcount,
    "calendar_once": q_calendar_once,
}


def _entry(field: str, rule: str, severity: str, fails: str) -> str:
    return (f"SELECT '{field}' AS field, '{rule}' AS rule, '{severity}' AS severity, p_name AS record_key, "
            f"CAST({field} AS VARCHAR) AS actual_value FROM p WHERE {fails}")


ORACLE = {
    "scd2_late_correction": HISTORY_ORACLE["scd2_replay"],
    "scd2_stream": HISTORY_ORACLE["scd2_replay"],
    "payroll_lines": f"""
WITH lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS employee_id, strftime(l_shipdate, '%Y-%m') AS period, l_linenumber, l_orderkey,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem),
valid AS (
  SELECT employee_id, period, price AS pay, 2 AS sent FROM lines WHERE l_linenumber <> 2
  UNION ALL
  SELECT employee_id, period, CAST(price + 1 AS DECIMAL(18,2)), 1 FROM lines WHERE l_orderkey % {RESENT_ORDERS} = 0),
known AS (
  SELECT v.* FROM valid v
  WHERE employee_id IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderpriority <> '5-LOW') AND pay >= 0)
SELECT employee_id, period, CAST(pay AS VARCHAR) AS gross_pay, CAST(pay AS VARCHAR) AS net_pay, 'file-' || sent AS _source_file_name
FROM (SELECT *, max(sent) OVER (PARTITION BY employee_id, period) AS newest FROM known) k WHERE sent = newest
""",
    "dq_critical": f"""
WITH p AS (SELECT p_name, p_size, p_retailprice, CASE WHEN p_partkey % {LOST_PARTS} <> 0 THEN p_partkey END AS p_partkey FROM part),
e AS (
  {_entry("p_partkey", "p_partkey IS NOT NULL", "CRITICAL", "p_partkey IS NULL")}
  UNION ALL
  {_entry("p_size", "p_size > 5", "ERROR", "NOT coalesce(p_size > 5, false) AND p_partkey IS NOT NULL")}
  UNION ALL
  {_entry("p_retailprice", "p_retailprice > 1000", "WARNING", "NOT coalesce(p_retailprice > 1000, false) AND p_partkey IS NOT NULL")})
SELECT CAST(NULL AS TIMESTAMP) AS _ingested_at, CAST(NULL AS VARCHAR) AS _source_file_name, 'part' AS entity, record_key,
       CAST(NULL AS VARCHAR) AS period, field, rule, severity, actual_value, true AS requires_review, false AS resolved,
       CAST(NULL AS VARCHAR) AS resolved_by, CAST(NULL AS TIMESTAMP) AS resolved_at, CAST(NULL AS VARCHAR) AS resolution_type
FROM e
""",
    "restated_headcount": f"SELECT period, count(DISTINCT o_custkey) AS headcount FROM ({QUALITY_ORACLE['restate']}) r GROUP BY period",
    "calendar_once": FACT_ORACLE["dim_date"],
}
