"""Tenure days and bands (D5): the reference's dates and edges."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.bands import salary_band, tenure_band
from tidemark.operators.facts import with_tenure


@pytest.mark.parametrize("hire,expected", [("2023-01-01", 731), ("2024-07-01", 184),
                                           ("2020-01-01", 1827), ("2021-07-01", 1280)])
def test_tenure_days(spark, hire, expected):
    df = spark.createDataFrame([(hire, "2025-01")], "hire_date string, period string")
    r = with_tenure(df, "period", "hire_date").first()
    assert r["tenure_days"] == expected


def test_future_hire_and_null_give_null(spark):
    df = spark.createDataFrame([("2025-06-01", "2025-01"), (None, "2025-01"), ("garbage", "2025-01")],
                               "hire_date string, period string")
    out = with_tenure(df, "period", "hire_date").collect()
    assert [r["tenure_days"] for r in out] == [None, None, None]
    assert [r["tenure_band"] for r in out] == [None, None, None]
    assert out[0]["tenure_days_raw"] < 0


@pytest.mark.parametrize("days,band", [(0, "0-1 year"), (364, "0-1 year"), (365, "1-3 years"),
                                       (1094, "1-3 years"), (1095, "3-5 years"), (1824, "3-5 years"),
                                       (1825, "5+ years"), (5000, "5+ years")])
def test_band_edges(spark, days, band):
    assert spark.range(1).select(tenure_band(F.lit(days))).first()[0] == band


def test_salary_bands(spark):
    vals = [49999, 50000, 79999, 80000, 119999, 120000]
    got = [spark.range(1).select(salary_band(F.lit(v))).first()[0] for v in vals]
    assert got == ["Band 1", "Band 2", "Band 2", "Band 3", "Band 3", "Band 4"]
