"""The physical plans keep the properties the design relies on at scale."""

import os

import pytest

import __spark_entry__ as E
from tidemark.operators.dedup import latest_per_key

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_row_combines_before_the_shuffle(spark):
    # one key holding most rows: the partial aggregate runs before the exchange
    rows = [("hot", i, f"v{i}") for i in range(300)] + [(f"k{i}", i, "x") for i in range(100)]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    p = plan(latest_per_key(df, ["k"], ["t"]))
    assert p.index("partial_max") > p.index("Exchange hashpartitioning")  # printed top-down
    got = latest_per_key(df, ["k"], ["t"]).where("k = 'hot'").first()
    assert (got["t"], got["v"]) == (299, "v299")


def test_no_query_has_cartesian_or_nested_loop_joins(spark):
    for name, fn in E.queries().items():
        if name == "ingest_roundtrip":
            continue
        p = plan(fn(spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def jobs_started_by(spark, build):
    """Jobs that building a DataFrame runs (none: its plan is declared only)."""
    group = f"build-{build.__name__}"
    spark.sparkContext.setJobGroup(group, "build")
    try:
        build(spark, SF)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_movements_scan_once_and_read_the_periods_off_the_raw_column(spark):
    from tidemark.plans.history_queries import q_movements, q_part_supplier_history, q_scd2_replay
    for build, column in ((q_movements, "ts"), (q_scd2_replay, "ts"), (q_part_supplier_history, "l_shipdate")):
        p = plan(build(spark, SF))
        # the only join is that of the period sequence
        assert p.count("Join") == 1 and "BroadcastHashJoin" in p and "SortMergeJoin" not in p
        # the snapshots, and the raw column of the periods; by key, the distinct
        # periods, and those few to one task
        assert p.count("FileScan parquet") == 2
        assert p.count("Exchange hashpartitioning") <= 3 and p.count("Exchange SinglePartition") == 1
        assert column in p
        # reading the table's schema is Spark's own small job; nothing else runs
        assert jobs_started_by(spark, build) <= 2


def test_fold_plan_grows_by_one_join_per_snapshot(spark):
    from tidemark.operators.scd2 import apply_snapshot, empty_dimension
    snaps = spark.range(5).selectExpr("id AS k", "'a' AS v")
    dim = empty_dimension(snaps, ["k"], ["v"])
    sizes = []
    for i in range(8):
        dim = apply_snapshot(dim, snaps, ["k"], ["v"], f"2025-0{i + 1}")
        sizes.append(dim._jdf.queryExecution().analyzed().collectLeaves().size())
    assert sizes == [2 + i for i in range(8)]


def test_semi_join_stays_semi(spark):
    p = plan(E.queries()["payroll_valid"](spark, SF))
    assert "LeftSemi" in p and "Inner" not in p


def test_scans_read_only_needed_columns(spark):
    p = E.queries()["headcount_gate"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in p
