"""Readers and derived snapshots over the driver's test tables.

Each test table stands in for a snapshot entity of the warehouse:

* ``events`` -> daily snapshot of each user's state (last event type of the day);
* ``orders`` -> monthly snapshot of each customer (hire = first order);
* ``lineitem`` -> monthly snapshot of which supplier ships each part, and
  pay-like amounts;
* ``customer``, ``nation``, ``region``, ``supplier``, ``part`` -> dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.periods import period_of
from tidemark.operators.dedup import latest_per_key


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def user_day_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, period, state): the user's last event type of each day."""
    e = table(spark, sf_dir, "events")
    daily = e.select("user_id", period_of("ts", "yyyy-MM-dd").alias("period"),
                     F.col("event_type").alias("state"), "ts", "event_id")
    return latest_per_key(daily, ["user_id", "period"], ["ts", "event_id"]).select(
        "user_id", "period", "state")


def part_month_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_partkey, period, l_suppkey): supplier of the part's last shipment each month."""
    li = table(spark, sf_dir, "lineitem")
    monthly = li.select("l_partkey", period_of("l_shipdate").alias("period"), "l_suppkey",
                        "l_shipdate", "l_orderkey", "l_linenumber")
    return latest_per_key(monthly, ["l_partkey", "period"],
                          ["l_shipdate", "l_orderkey", "l_linenumber"]).select(
        "l_partkey", "period", "l_suppkey")


def user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw period column of the user snapshots."""
    e = table(spark, sf_dir, "events").where(F.col("user_id").isNotNull())
    return e.select(period_of("ts", "yyyy-MM-dd").alias("period"))


def part_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw period column of the part snapshots."""
    li = table(spark, sf_dir, "lineitem").where(F.col("l_partkey").isNotNull())
    return li.select(period_of("l_shipdate").alias("period"))


# Shared SQL (DuckDB) for the same snapshots, used by the oracles.
USER_DAY_SNAP_SQL = """
snap AS (
  SELECT user_id, period, state FROM (
    SELECT user_id, strftime(ts, '%Y-%m-%d') AS period, event_type AS state,
           row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d')
                              ORDER BY ts DESC, event_id DESC) AS rn
    FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL) t
  WHERE rn = 1)
"""

PART_MONTH_SNAP_SQL = """
psnap AS (
  SELECT l_partkey, period, l_suppkey FROM (
    SELECT l_partkey, strftime(l_shipdate, '%Y-%m') AS period, l_suppkey,
           row_number() OVER (PARTITION BY l_partkey, strftime(l_shipdate, '%Y-%m')
                              ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn
    FROM lineitem WHERE l_partkey IS NOT NULL AND l_shipdate IS NOT NULL) t
  WHERE rn = 1)
"""
