"""Reporting aggregates (A1-A6, A2r; J1, J2, G1, G2, W4).

Each mart is: optional filter -> left joins to current dimension rows ->
group and count. Dimensions are joined by name; Spark picks broadcast or
sort-merge from their measured size (AQE), so no hint is forced here.
Percentages use exact integer rounding (``pct_2dp``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.bands import pct_2dp

# A dimension join: (dimension rows, join key(s)). The dimension should be
# reduced to its key and the attributes the mart needs.
DimJoin = tuple[DataFrame, str | Sequence[str]]


def join_dims(fact: DataFrame, dims: Sequence[DimJoin]) -> DataFrame:
    out = fact
    for dim, on in dims:
        out = out.join(dim, on=on, how="left")
    return out


def count_by(fact: DataFrame, dims: Sequence[DimJoin], group: Sequence[str], counted: str,
             alias: str, where: Column | None = None) -> DataFrame:
    """Filter, join, ``count(counted)`` by ``group`` (A1, A2, A4)."""
    if where is not None:
        fact = fact.where(where)
    return join_dims(fact, dims).groupBy(*group).agg(F.count(counted).alias(alias))


def headcount_monthly(fact: DataFrame, dims: Sequence[DimJoin],
                      group: Sequence[str] = ("period", "department_id", "department_name",
                                              "contract_type", "band", "tenure_band"),
                      key: str = "employee_id", active: Column | None = None) -> DataFrame:
    """A1: active rows per period and attributes."""
    active = F.col("termination_date").isNull() if active is None else active
    return count_by(fact, dims, group, key, "employee_count", active).select(
        *group, "employee_count")


def attrition_summary(moves: DataFrame, departments: DataFrame, key: str = "employee_id",
                      dept_col: str = "department_id", name_col: str = "department_name",
                      event_col: str = "event_type", from_col: str = "from_department_id",
                      period_col: str = "period") -> DataFrame:
    """A2: terminations per period and the department they left."""
    dept = departments.select(F.col(dept_col).alias(from_col), F.col(name_col).alias(name_col))
    out = count_by(moves, [(dept, from_col)], [period_col, from_col, name_col], key,
                   "termination_count", F.col(event_col) == "TERMINATION")
    return out.select(period_col, F.col(from_col).alias(dept_col), name_col, "termination_count")


def rolling_attrition(summary: DataFrame, months: int = 12, period_col: str = "period",
                      dept_col: str = "department_id", name_col: str = "department_name",
                      count_col: str = "termination_count", last_period=None) -> DataFrame:
    """A2r: terminations over the trailing ``months`` calendar months.

    Each monthly count is sent to the ``months`` months it belongs to (an
    ``explode`` of a short sequence, no cross join), then summed. Months
    after ``last_period`` (default: the latest month in ``summary``) are
    dropped. One row per department and month with a non-zero total.
    """
    if last_period is None:
        last_period = summary.select(F.max(period_col)).scalar()
    last = F.try_to_date(last_period if isinstance(last_period, Column) else F.lit(last_period),
                     "yyyy-MM")
    start = F.try_to_date(F.col(period_col), "yyyy-MM")
    spread = summary.select(
        dept_col, name_col, count_col,
        F.explode(F.sequence(F.lit(0), F.lit(months - 1))).alias("_k"),
        start.alias("_d"),
    ).withColumn("_t", F.add_months("_d", F.col("_k")))
    spread = spread.withColumn("_last", last).where(F.col("_t") <= F.col("_last"))
    return spread.groupBy(F.date_format("_t", "yyyy-MM").alias(period_col), dept_col, name_col).agg(
        F.sum(count_col).alias(f"{count_col}_{months}m"))


def compensation_bands(comp: DataFrame, dims: Sequence[DimJoin],
                       group: Sequence[str] = ("band", "job_family", "department_name"),
                       key: str = "employee_id", salary: str = "salary") -> DataFrame:
    """A3: count / avg / min / max salary per band, family and department."""
    return join_dims(comp, dims).groupBy(*group).agg(
        F.count(key).alias("employee_count"),
        F.avg(salary).alias("avg_salary"),
        F.min(salary).alias("min_salary"),
        F.max(salary).alias("max_salary"),
    ).select(*group, "employee_count", "avg_salary", "min_salary", "max_salary")


def workforce_movements(moves: DataFrame, departments: DataFrame, key: str = "employee_id",
                        dept_col: str = "department_id", name_col: str = "name",
                        from_col: str = "from_department_id", to_col: str = "department_id",
                        event_col: str = "event_type", period_col: str = "period") -> DataFrame:
    """A4: movements by period, type and the two department names."""
    d_from = departments.select(F.col(dept_col).alias(from_col),
                                F.col(name_col).alias("from_department_name"))
    d_to = departments.select(F.col(dept_col).alias(to_col),
                              F.col(name_col).alias("to_department_name"))
    group = [period_col, event_col, "from_department_name", "to_department_name"]
    return count_by(moves, [(d_from, from_col), (d_to, to_col)], group, key, "movement_count")


def tenure_bands(fact: DataFrame, dims: Sequence[DimJoin],
                 group: Sequence[str] = ("period", "department_id", "department_name",
                                         "contract_type", "tenure_band"),
                 share_of: Sequence[str] = ("period", "department_id"),
                 key: str = "employee_id", active: Column | None = None) -> DataFrame:
    """A5: banded active headcount and its percent of (period, department)."""
    active = F.col("termination_date").isNull() if active is None else active
    counts = count_by(fact, dims, group, key, "employee_count",
                      active & F.col("tenure_band").isNotNull())
    return with_share(counts, share_of).select(*group, "employee_count", "pct_of_department")


def with_share(counts: DataFrame, share_of: Sequence[str] = ("period", "department_id")) -> DataFrame:
    """Each count's percent of the total of its ``share_of`` group."""
    total = F.sum("employee_count").over(Window.partitionBy(*share_of))
    return (counts.withColumn("_total", total)
            .withColumn("pct_of_department", pct_2dp(F.col("employee_count"), F.col("_total"))).drop("_total"))
