"""Headcount gate (V1): strict threshold, no history, zero periods."""

import pytest

from tidemark.operators.gate import HeadcountAnomaly, assert_no_anomaly, headcount_gate


def series(spark, counts):
    rows = []
    for i, n in enumerate(counts):
        rows += [(f"E{j}", f"2025-{i + 1:02d}") for j in range(n)]
    return spark.createDataFrame(rows, "employee_id string, period string")


@pytest.mark.parametrize("current,anomaly", [(89, True), (115, True), (90, False), (92, False),
                                              (110, False), (100, False)])
def test_strict_threshold(spark, current, anomaly):
    g = headcount_gate(series(spark, [100, 100, 100, current]), "employee_id", threshold_pct=10)
    r = g.where("period = '2025-04'").first()
    assert r["rolling_avg"] == 100 and r["is_anomaly"] is anomaly


def test_no_history_is_not_anomaly(spark):
    g = headcount_gate(series(spark, [50]), "employee_id").first()
    assert g["rolling_avg"] is None and g["is_anomaly"] is False


def test_only_three_latest_nonzero_periods_count(spark):
    from pyspark.sql import functions as F
    df = series(spark, [10, 100, 100, 100, 100])
    # a period where nobody is active counts 0 and is skipped by later means
    inactive = spark.createDataFrame([("X", "2025-06")], "employee_id string, period string")
    df = df.unionByName(inactive)
    g = headcount_gate(df, "employee_id", active=F.col("employee_id") != "X", threshold_pct=10)
    rows = {r["period"]: r for r in g.collect()}
    assert rows["2025-05"]["rolling_avg"] == 100
    assert rows["2025-06"]["headcount"] == 0 and rows["2025-06"]["is_anomaly"] is True
    with pytest.raises(HeadcountAnomaly):
        assert_no_anomaly(g, "2025-06")
    assert assert_no_anomaly(g, "2025-05")["headcount"] == 100
    with pytest.raises(HeadcountAnomaly):
        assert_no_anomaly(g, "2024-01")
