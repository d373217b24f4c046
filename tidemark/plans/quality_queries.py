"""Queries for the quality log, steward review, restatement, rescue and ingest
(Q1, Q2, J4, V2, V3, A6, R1, S1-S6)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.periods import period_from_path, period_of
from tidemark.operators import quality as dq
from tidemark.operators.facts import optional_column
from tidemark.operators.restate import restate
from tidemark.plans.source_tables import table
from tidemark.plans.table_rules import TABLE_RULES
from tidemark.session import scratch_dir
from tidemark.sources.landing import export_by_period, parse_with_rescue
from tidemark.sources.rules import Rule, RuleSet
from tidemark.streaming.ingest import ingest_to_bronze

RULES = RuleSet.from_dict(TABLE_RULES)

# The steward's resolution applied in the resolution query.
RESOLVED_AT = _dt.datetime(2025, 1, 31, 0, 0, 0)
RESOLVED_BY = "steward"
RESOLUTION = "ACCEPT"

# The restatement scope used on orders.
RESTATE_START, RESTATE_END = "1996-01", "1996-12"


def q_dq_log(spark: SparkSession, d: str) -> DataFrame:
    """Q2: every rule failure on customers and orders, one scan per entity."""
    cust = table(spark, d, "customer")
    orders = table(spark, d, "orders")
    refs = {"solvent_customers": cust.where(F.col("c_acctbal") >= 0)}
    c_log = dq.quality_log(cust, "customer", RULES.entity_rules("customer"), key="c_custkey")
    o_log = dq.quality_log(orders, "orders", RULES.entity_rules("orders"), key="o_orderkey",
                           period=period_of("o_orderdate"), ingested=F.col("o_orderdate"),
                           refs=refs)
    return dq.union_logs([c_log, o_log])


def _resolutions(log: DataFrame) -> DataFrame:
    return log.where((F.col("entity") == "customer") & (F.col("severity") == "ERROR")).select(
        "entity", "field", "record_key", "_ingested_at",
        F.lit(RESOLVED_BY).alias("resolved_by"),
        F.lit(RESOLVED_AT).cast("timestamp").alias("resolved_at"),
        F.lit(RESOLUTION).alias("resolution_type"))


def q_dq_resolved(spark: SparkSession, d: str) -> DataFrame:
    """V3: the log with customer ERROR entries resolved by the steward."""
    log = q_dq_log(spark, d)
    return dq.resolve(log, _resolutions(log), on=["entity", "field", "record_key", "_ingested_at"])


def q_dq_summary(spark: SparkSession, d: str) -> DataFrame:
    """V2: open issue counts after resolution."""
    return dq.summary(q_dq_resolved(spark, d))


def q_dq_review(spark: SparkSession, d: str) -> DataFrame:
    """Open issues, worst first."""
    return dq.review(q_dq_resolved(spark, d))


def q_restate(spark: SparkSession, d: str) -> DataFrame:
    """Urgent orders of 1996 restated (+100 on the total) for their customers;
    every other 1996 order of those customers is withdrawn."""
    base = table(spark, d, "orders").withColumn("period", period_of("o_orderdate"))
    corr = base.where(F.col("o_orderpriority") == "1-URGENT").withColumn(
        "o_totalprice", F.col("o_totalprice") + F.lit(100.0))
    return restate(base, corr, ["o_custkey"], "period", RESTATE_START, RESTATE_END)


# Fixed value: the fields declared for the event landing documents; the rest
# of each document is rescued.
EVENT_DECLARED = ["event_id", "user_id", "event_type"]


def q_rescue_fields(spark: SparkSession, d: str) -> DataFrame:
    """Events as JSON documents; undeclared fields go to ``_rescued_data``."""
    e = table(spark, d, "events")
    doc = F.to_json(F.struct("event_id", "user_id", "event_type", "value",
                             F.get_json_object("props", "$.k").alias("k")))
    return e.select(*parse_with_rescue(doc, EVENT_DECLARED))


def q_rescued_late_column(spark: SparkSession, d: str) -> DataFrame:
    """A column absent from the declared schema (``k``) is still
    selected, from the rescued JSON, as the reference's late
    ``compensation_category`` should have been."""
    docs = q_rescue_fields(spark, d)
    return docs.select("event_id", "user_id", optional_column(docs, "k").alias("k"),
                       optional_column(docs, "value").alias("value"))


def q_ingest_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Land events as JSON by day, stream them into bronze
    (availableNow, checkpointed), read bronze back with the period from the path."""
    root = scratch_dir(spark, "ingest")
    e = table(spark, d, "events").withColumn("period", period_of("ts", "yyyy-MM-dd"))
    export_by_period(e, f"{root}/landing", "events", "period")
    fields = ["event_id", "ts", "user_id", "event_type", "value"]
    ingest_to_bronze(spark, f"{root}/landing", "events", f"{root}/bronze",
                     f"{root}/_checkpoint", fields, run_id="roundtrip",
                     layout="{base}/{entity}/*/")
    # A second run over the same landing must add nothing.
    ingest_to_bronze(spark, f"{root}/landing", "events", f"{root}/bronze",
                     f"{root}/_checkpoint", fields, run_id="second run",
                     layout="{base}/{entity}/*/")
    bronze = spark.read.parquet(f"{root}/bronze")
    audited = F.col("_ingested_at").isNotNull() & F.col("_file_modified_at").isNotNull()
    return bronze.select(
        "event_id", "user_id", "event_type", "value",
        F.get_json_object("_rescued_data", "$.props").alias("props"),
        period_from_path("_source_file_name").alias("period"), "_pipeline_run_id",
        audited.alias("audited"))


QUERIES = {
    "dq_log": q_dq_log,
    "dq_resolved": q_dq_resolved,
    "dq_summary": q_dq_summary,
    "dq_review": q_dq_review,
    "restate": q_restate,
    "rescue_fields": q_rescue_fields,
    "rescued_late_column": q_rescued_late_column,
    "ingest_roundtrip": q_ingest_roundtrip,
}


def _rule_violation_sql(r: Rule) -> str:
    if r.kind == "referential":
        return (f"({r.field} IS NOT NULL AND {r.field} NOT IN "
                f"(SELECT {r.ref_key} FROM {r.ref} WHERE {r.ref_key} IS NOT NULL))")
    return f"(NOT coalesce(({r.rule}), false))"


def _entity_log_sql(entity: str, key: str, period: str, ingested: str) -> str:
    rules = RULES.entity_rules(entity)
    crit = [_rule_violation_sql(r) for r in rules if r.severity == "CRITICAL"]
    any_crit = " OR ".join(crit) if crit else "false"
    parts = []
    for r in rules:
        cond = _rule_violation_sql(r)
        if r.severity != "CRITICAL":
            cond = f"{cond} AND NOT ({any_crit})"
        rule_text = r.rule.replace("'", "''")
        parts.append(
            f"SELECT {ingested} AS _ingested_at, CAST(NULL AS VARCHAR) AS _source_file_name, "
            f"'{entity}' AS entity, CAST({key} AS VARCHAR) AS record_key, {period} AS period, "
            f"'{r.field}' AS field, '{rule_text}' AS rule, '{r.severity}' AS severity, "
            f"CAST({r.field} AS VARCHAR) AS actual_value FROM {entity} WHERE {cond}")
    return "\nUNION ALL\n".join(parts)


_DQ_LOG_SQL = f"""
WITH solvent_customers AS (SELECT * FROM customer WHERE c_acctbal >= 0),
raw AS (
{_entity_log_sql("customer", "c_custkey", "CAST(NULL AS VARCHAR)", "CAST(NULL AS TIMESTAMP)")}
UNION ALL
{_entity_log_sql("orders", "o_orderkey", "strftime(o_orderdate, '%Y-%m')", "CAST(o_orderdate AS TIMESTAMP)")}
),
log AS (
SELECT _ingested_at, _source_file_name, entity, record_key, period, field, rule, severity,
       actual_value, true AS requires_review, false AS resolved,
       CAST(NULL AS VARCHAR) AS resolved_by, CAST(NULL AS TIMESTAMP) AS resolved_at,
       CAST(NULL AS VARCHAR) AS resolution_type
FROM raw)
"""

_RESOLVED_SQL = _DQ_LOG_SQL + f""",
resolved AS (
SELECT _ingested_at, _source_file_name, entity, record_key, period, field, rule, severity,
       actual_value, requires_review,
       CASE WHEN hit THEN true ELSE resolved END AS resolved,
       CASE WHEN hit THEN '{RESOLVED_BY}' ELSE resolved_by END AS resolved_by,
       CASE WHEN hit THEN TIMESTAMP '{RESOLVED_AT:%Y-%m-%d %H:%M:%S}' ELSE resolved_at END AS resolved_at,
       CASE WHEN hit THEN '{RESOLUTION}' ELSE resolution_type END AS resolution_type
FROM (SELECT *, (entity = 'customer' AND severity = 'ERROR') AS hit FROM log) x)
"""

ORACLE = {
    "dq_log": _DQ_LOG_SQL + "SELECT * FROM log",
    "dq_resolved": _RESOLVED_SQL + "SELECT * FROM resolved",
    "dq_summary": _RESOLVED_SQL + """
SELECT count(*) AS total_issues,
       count(*) FILTER (WHERE severity = 'CRITICAL') AS critical,
       count(*) FILTER (WHERE severity = 'ERROR') AS errors,
       count(*) FILTER (WHERE severity = 'WARNING') AS warnings
FROM resolved WHERE NOT coalesce(resolved, false)
  AND severity IN ('CRITICAL', 'ERROR', 'WARNING')
""",
    "dq_review": _RESOLVED_SQL + """
SELECT * FROM resolved WHERE NOT coalesce(resolved, false)
  AND severity IN ('CRITICAL', 'ERROR', 'WARNING')
""",
    "restate": f"""
WITH b AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS period FROM orders),
c AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 100.0 AS o_totalprice,
             o_orderdate, o_orderpriority, period
      FROM b WHERE o_orderpriority = '1-URGENT'
        AND period >= '{RESTATE_START}' AND period <= '{RESTATE_END}'),
s AS (SELECT DISTINCT o_custkey FROM c WHERE o_custkey IS NOT NULL)
SELECT * FROM b
WHERE NOT coalesce(period >= '{RESTATE_START}' AND period <= '{RESTATE_END}'
                   AND o_custkey IN (SELECT o_custkey FROM s), false)
UNION ALL
SELECT * FROM c
""",
    "ingest_roundtrip": """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
       CAST(value AS VARCHAR) AS value, props, strftime(ts, '%Y-%m-%d') AS period,
       'roundtrip' AS _pipeline_run_id, true AS audited
FROM events
""",
    "rescued_late_column": """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
       json_extract_string(props, '$.k') AS k, CAST(value AS VARCHAR) AS value
FROM events
""",
    "rescue_fields": """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
       '{"value":"' || CAST(value AS VARCHAR) || '","k":"' || json_extract_string(props, '$.k') || '"}'
         AS _rescued_data
FROM events
""",
}
