"""Queries for the date dimension, facts and gold marts (D1a, D5-D7, A1-A5, A2r, V1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.periods import period_of, period_start
from tidemark.operators import marts
from tidemark.operators import movements as mv
from tidemark.operators.calendar import dim_date_covering
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.facts import compensation_fact, payroll_fact, repair_before, with_tenure
from tidemark.operators.gate import headcount_gate
from tidemark.plans.source_tables import (
    PART_MONTH_SNAP_SQL,
    USER_DAY_SNAP_SQL,
    part_month_snapshots,
    part_months,
    table,
    user_day_snapshots,
)

# Fixed value: the gate's threshold for the daily user snapshot, in percent.
GATE_THRESHOLD_PCT = 2.0

# The order status that ends a customer's employment, and the
# segment whose termination dates are recorded wrongly.
LEFT_STATUS, EARLY_SEGMENT = "F", "BUILDING"


def q_dim_date(spark: SparkSession, d: str) -> DataFrame:
    """Calendar covering every order date (fiscal year starts in October)."""
    return dim_date_covering(table(spark, d, "orders"), "o_orderdate")


def q_headcount_fact(spark: SparkSession, d: str) -> DataFrame:
    """One row per customer and month (its latest order that month), with
    hire = first order ever, department = the customer's nation, tenure. A
    customer whose last order has LEFT_STATUS left on its day; those of
    EARLY_SEGMENT have a day before their hire on record, which is nulled."""
    o = table(spark, d, "orders")
    rows = o.select("o_custkey", period_of("o_orderdate").alias("period"), "o_orderdate",
                    "o_orderkey", "o_orderstatus", F.col("o_orderpriority").alias("role_id"))
    monthly = latest_per_key(rows, ["o_custkey", "period"], ["o_orderdate", "o_orderkey"],
                             also={"_first": F.min("o_orderdate")})
    # One row per customer and month here, so this window's partitions are
    # bounded by the number of months, whatever the skew of the raw orders.
    by_customer = Window.partitionBy("o_custkey")
    hire = F.min("_first").over(by_customer).cast("date")
    last = F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus")).over(by_customer)
    # period_date is computed below the window, so filters on tenure pushed
    # down later stop at the window instead of re-deriving it per use.
    monthly = monthly.select("o_custkey", "period", "role_id", hire.alias("hire_date"),
                             last.alias("_last"), period_start(F.col("period")).alias("period_date"))
    cust = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment",
                                              F.col("c_nationkey").alias("department_id"))
    recorded = F.when(F.col("_last.o_orderstatus") == LEFT_STATUS, F.when(
        F.col("c_mktsegment") == EARLY_SEGMENT, F.date_sub("hire_date", 1)).otherwise(
        F.col("_last.o_orderdate").cast("date")))
    joined = monthly.join(cust, "o_custkey", "left").withColumn("termination_date", recorded)
    fact = with_tenure(repair_before(joined, "termination_date", "hire_date"), "period", F.col("hire_date"))
    return fact.select("o_custkey", "period", "department_id", "role_id", "hire_date",
                       "termination_date", "period_date", "tenure_days_raw", "tenure_days",
                       "tenure_band")


def q_payroll_valid(spark: SparkSession, d: str) -> DataFrame:
    """Line amounts of orders whose customer has a non-negative balance."""
    li = table(spark, d, "lineitem")
    pay = li.select("l_orderkey", "l_linenumber", period_of("l_shipdate").alias("period"),
                    F.col("l_extendedprice").alias("gross_pay"),
                    (F.col("l_extendedprice") * F.col("l_discount")).alias("deductions"),
                    (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_pay"))
    good_cust = table(spark, d, "customer").where(F.col("c_acctbal") >= 0)
    orders = table(spark, d, "orders")
    valid = orders.join(good_cust, orders.o_custkey == good_cust.c_custkey, "left_semi").select(
        F.col("o_orderkey").alias("l_orderkey"))
    return payroll_fact(pay, valid, "l_orderkey",
                        ["l_orderkey", "l_linenumber", "period", "gross_pay", "deductions",
                         "net_pay"], cast="double")


def _order_comp(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey",
        F.round("o_totalprice").cast("long").alias("salary"))
    return compensation_fact(o, "o_custkey", "salary", ["o_orderkey", "o_custkey", "salary"],
                             cast="long")


def q_compensation_banded(spark: SparkSession, d: str) -> DataFrame:
    """D7 + F6: order totals (whole units) as pay, valid and banded."""
    return _order_comp(spark, d)


def _nation_dim(spark, d):
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("department_id"),
                                            F.col("n_name").alias("department_name"),
                                            "n_regionkey")


def q_headcount_monthly(spark: SparkSession, d: str) -> DataFrame:
    """A1: active customers per month, nation, segment, region and tenure band."""
    fact = q_headcount_fact(spark, d)
    region = table(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"),
                                              F.col("r_name").alias("band"))
    contracts = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                                   F.col("c_mktsegment").alias("contract_type"))
    return marts.headcount_monthly(
        fact, [(_nation_dim(spark, d), "department_id"), (region, "n_regionkey"),
               (contracts, "o_custkey")], key="o_custkey")


def q_tenure_bands(spark: SparkSession, d: str) -> DataFrame:
    """A5: banded active customers and their percent of (month, nation)."""
    fact = q_headcount_fact(spark, d)
    contracts = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                                   F.col("c_mktsegment").alias("contract_type"))
    return marts.tenure_bands(fact, [(_nation_dim(spark, d).drop("n_regionkey"), "department_id"),
                                     (contracts, "o_custkey")], key="o_custkey")


def q_compensation_bands(spark: SparkSession, d: str) -> DataFrame:
    """A3: pay count / avg / min / max by pay band, segment and nation."""
    comp = _order_comp(spark, d).withColumnRenamed("salary_band", "band")
    cust = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                              F.col("c_mktsegment").alias("job_family"),
                                              F.col("c_nationkey").alias("department_id"))
    return marts.compensation_bands(
        comp, [(cust, "o_custkey"), (_nation_dim(spark, d).drop("n_regionkey"), "department_id")],
        key="o_custkey")


def supplier_moves(spark: SparkSession, d: str) -> DataFrame:
    """M4 over parts: which supplier ships each part, month by month."""
    return mv.movements(part_month_snapshots(spark, d), ["l_partkey"], "period", ["l_suppkey"],
                        periods=part_months(spark, d))


def _supplier_dim(spark, d):
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("department_id"),
                                              F.col("s_name").alias("department_name"))


def q_attrition_summary(spark: SparkSession, d: str) -> DataFrame:
    """A2: parts that stopped shipping, per month and last supplier."""
    return marts.attrition_summary(supplier_moves(spark, d), _supplier_dim(spark, d),
                                   key="l_partkey", from_col="from_l_suppkey")


def q_attrition_rolling(spark: SparkSession, d: str) -> DataFrame:
    """A2r: the same over the trailing 12 months, up to the last month shipped.

    The last month is that of the last day shipped, one scalar over one column
    of ``lineitem`` (a cheap scan, formatted once), not over the summary, which
    would re-run the whole movement plan."""
    li = table(spark, d, "lineitem").where(F.col("l_partkey").isNotNull())
    last = li.agg(F.max("l_shipdate").alias("day")).select(period_of("day")).first()[0]
    return marts.rolling_attrition(q_attrition_summary(spark, d), last_period=last)


def q_workforce_movements(spark: SparkSession, d: str) -> DataFrame:
    """A4: supplier movements per month, type, from- and to-supplier name."""
    return marts.workforce_movements(supplier_moves(spark, d), _supplier_dim(spark, d),
                                     key="l_partkey", name_col="department_name",
                                     from_col="from_l_suppkey", to_col="l_suppkey")


def q_headcount_gate(spark: SparkSession, d: str) -> DataFrame:
    """V1: daily active users vs the mean of the 3 prior days, 2 % threshold."""
    return headcount_gate(user_day_snapshots(spark, d), "user_id", "period",
                          threshold_pct=GATE_THRESHOLD_PCT)


QUERIES = {
    "dim_date": q_dim_date,
    "headcount_fact": q_headcount_fact,
    "payroll_valid": q_payroll_valid,
    "compensation_banded": q_compensation_banded,
    "headcount_monthly": q_headcount_monthly,
    "tenure_bands": q_tenure_bands,
    "compensation_bands": q_compensation_bands,
    "attrition_summary": q_attrition_summary,
    "attrition_rolling": q_attrition_rolling,
    "workforce_movements": q_workforce_movements,
    "headcount_gate": q_headcount_gate,
}

_FACT_SQL = f"""
WITH m AS (
  SELECT o_custkey, period, o_orderpriority AS role_id FROM (
    SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS period, o_orderpriority,
           row_number() OVER (PARTITION BY o_custkey, strftime(o_orderdate, '%Y-%m')
                              ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL) t WHERE rn = 1),
h AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS hire_date
      FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL GROUP BY o_custkey),
l AS (
  SELECT o_custkey, CASE WHEN o_orderstatus = '{LEFT_STATUS}' THEN CAST(o_orderdate AS DATE) END AS left_on FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL) t WHERE rn = 1),
b AS (
  SELECT m.o_custkey, m.period, c.c_nationkey AS department_id, m.role_id, h.hire_date,
         CASE WHEN coalesce(c.c_mktsegment = '{EARLY_SEGMENT}', false) THEN NULL ELSE l.left_on END AS termination_date,
         CAST(strptime(m.period || '-01', '%Y-%m-%d') AS DATE) AS period_date
  FROM m JOIN h USING (o_custkey) JOIN l USING (o_custkey) LEFT JOIN customer c ON c.c_custkey = m.o_custkey),
f AS (
  SELECT *, CAST(date_diff('day', hire_date, period_date) AS INTEGER) AS tenure_days_raw FROM b),
fact AS (
  SELECT *, CASE WHEN tenure_days_raw < 0 THEN NULL ELSE tenure_days_raw END AS tenure_days,
         CASE WHEN tenure_days_raw IS NULL OR tenure_days_raw < 0 THEN NULL
              WHEN tenure_days_raw < 365 THEN '0-1 year'
              WHEN tenure_days_raw < 1095 THEN '1-3 years'
              WHEN tenure_days_raw < 1825 THEN '3-5 years'
              ELSE '5+ years' END AS tenure_band
  FROM f)
"""

_COMP_SQL = """
comp AS (
  SELECT o_orderkey, o_custkey, salary,
         CASE WHEN salary < 50000 THEN 'Band 1' WHEN salary < 80000 THEN 'Band 2'
              WHEN salary < 120000 THEN 'Band 3' ELSE 'Band 4' END AS salary_band
  FROM (SELECT o_orderkey, o_custkey, CAST(round(o_totalprice) AS BIGINT) AS salary
        FROM orders WHERE o_custkey IS NOT NULL) o
  WHERE salary IS NOT NULL AND salary > 0)
"""

_SUPPLIER_MOVES_SQL = f"""
{PART_MONTH_SNAP_SQL},
h AS (SELECT l_partkey, period, l_suppkey,
             lag(period) OVER w AS prev_period, lag(l_suppkey) OVER w AS prev_supp
      FROM psnap WINDOW w AS (PARTITION BY l_partkey ORDER BY period)),
p AS (SELECT period, lead(period) OVER (ORDER BY period) AS next_period
      FROM (SELECT DISTINCT period FROM psnap) d),
moves AS (
  SELECT l_partkey, period, 'HIRE' AS event_type, CAST(NULL AS BIGINT) AS from_l_suppkey, l_suppkey
  FROM h WHERE prev_period IS NULL
  UNION ALL
  SELECT l_partkey, period, 'TRANSFER', prev_supp, l_suppkey
  FROM h WHERE prev_period IS NOT NULL AND l_suppkey <> prev_supp
  UNION ALL
  SELECT c.l_partkey, p.next_period, 'TERMINATION', c.l_suppkey, CAST(NULL AS BIGINT)
  FROM psnap c JOIN p ON c.period = p.period
  WHERE p.next_period IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM psnap n WHERE n.l_partkey = c.l_partkey AND n.period = p.next_period)),
attr AS (
  SELECT m.period, m.from_l_suppkey AS department_id, s.s_name AS department_name,
         count(m.l_partkey) AS termination_count
  FROM moves m LEFT JOIN supplier s ON s.s_suppkey = m.from_l_suppkey
  WHERE m.event_type = 'TERMINATION'
  GROUP BY m.period, m.from_l_suppkey, s.s_name)
"""

ORACLE = {
    "dim_date": """
SELECT strftime(d, '%Y%m%d') AS date_id, strftime(d, '%Y-%m-%d') AS calendar_date,
       CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(year(d) + CASE WHEN month(d) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
       CAST(((month(d) + 2) % 12) + 1 AS INTEGER) AS fiscal_period,
       isodow(d) <= 5 AS is_working_day, dayname(d) AS day_of_week
FROM (SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE),
                                          CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d
      FROM orders) t
""",
    "headcount_fact": _FACT_SQL + """
SELECT o_custkey, period, department_id, role_id, hire_date, termination_date, period_date,
       tenure_days_raw, tenure_days, tenure_band FROM fact
""",
    "payroll_valid": """
SELECT l_orderkey, l_linenumber, period, gross_pay, deductions, net_pay FROM (
  SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m') AS period,
         l_extendedprice AS gross_pay, l_extendedprice * l_discount AS deductions,
         l_extendedprice * (1 - l_discount) AS net_pay
  FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_orderkey IN (
    SELECT o_orderkey FROM orders WHERE o_custkey IN (
      SELECT c_custkey FROM customer WHERE c_acctbal >= 0))) t
WHERE gross_pay IS NOT NULL AND gross_pay >= 0 AND net_pay IS NOT NULL AND net_pay >= 0
""",
    "compensation_banded": f"WITH {_COMP_SQL} SELECT * FROM comp",
    "headcount_monthly": _FACT_SQL + """
SELECT f.period, f.department_id, n.n_name AS department_name, c.c_mktsegment AS contract_type,
       r.r_name AS band, f.tenure_band, count(f.o_custkey) AS employee_count
FROM fact f LEFT JOIN nation n ON n.n_nationkey = f.department_id
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN customer c ON c.c_custkey = f.o_custkey
WHERE f.termination_date IS NULL
GROUP BY f.period, f.department_id, n.n_name, c.c_mktsegment, r.r_name, f.tenure_band
""",
    "tenure_bands": _FACT_SQL + """,
g AS (
  SELECT f.period, f.department_id, n.n_name AS department_name, c.c_mktsegment AS contract_type,
         f.tenure_band, count(f.o_custkey) AS employee_count
  FROM fact f LEFT JOIN nation n ON n.n_nationkey = f.department_id
  LEFT JOIN customer c ON c.c_custkey = f.o_custkey
  WHERE f.termination_date IS NULL AND f.tenure_band IS NOT NULL
  GROUP BY f.period, f.department_id, n.n_name, c.c_mktsegment, f.tenure_band)
SELECT period, department_id, department_name, contract_type, tenure_band, employee_count,
       floor((employee_count * 20000 + tot) / (2 * tot)) / 100.0 AS pct_of_department
FROM (SELECT *, sum(employee_count) OVER (PARTITION BY period, department_id) AS tot FROM g) x
""",
    "compensation_bands": f"""
WITH {_COMP_SQL}
SELECT comp.salary_band AS band, c.c_mktsegment AS job_family, n.n_name AS department_name,
       count(comp.o_custkey) AS employee_count, avg(comp.salary) AS avg_salary,
       min(comp.salary) AS min_salary, max(comp.salary) AS max_salary
FROM comp LEFT JOIN customer c ON c.c_custkey = comp.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
GROUP BY comp.salary_band, c.c_mktsegment, n.n_name
""",
    "attrition_summary": f"WITH {_SUPPLIER_MOVES_SQL} SELECT * FROM attr",
    "attrition_rolling": f"""
WITH {_SUPPLIER_MOVES_SQL},
spread AS (
  SELECT department_id, department_name, termination_count,
         CAST(strptime(period || '-01', '%Y-%m-%d') AS DATE) + to_months(CAST(k AS INTEGER)) AS t
  FROM attr, range(12) AS r(k))
SELECT strftime(t, '%Y-%m') AS period, department_id, department_name,
       CAST(sum(termination_count) AS BIGINT) AS termination_count_12m
FROM spread
WHERE t <= (SELECT CAST(strptime(max(strftime(l_shipdate, '%Y-%m')) || '-01', '%Y-%m-%d') AS DATE)
            FROM lineitem WHERE l_partkey IS NOT NULL)
GROUP BY strftime(t, '%Y-%m'), department_id, department_name
""",
    "workforce_movements": f"""
WITH {_SUPPLIER_MOVES_SQL}
SELECT m.period, m.event_type, sf.s_name AS from_department_name, st.s_name AS to_department_name,
       count(m.l_partkey) AS movement_count
FROM moves m LEFT JOIN supplier sf ON sf.s_suppkey = m.from_l_suppkey
LEFT JOIN supplier st ON st.s_suppkey = m.l_suppkey
GROUP BY m.period, m.event_type, sf.s_name, st.s_name
""",
    "headcount_gate": f"""
WITH {USER_DAY_SNAP_SQL},
h AS (SELECT period, count(DISTINCT user_id) AS headcount FROM snap GROUP BY period),
r AS (
  SELECT h.period, h.headcount,
         (SELECT avg(x.headcount) FROM (
            SELECT h2.headcount FROM h h2 WHERE h2.period < h.period AND h2.headcount > 0
            ORDER BY h2.period DESC LIMIT 3) x) AS rolling_avg
  FROM h)
SELECT period, headcount, rolling_avg,
       CASE WHEN rolling_avg > 0 THEN abs(headcount - rolling_avg) / rolling_avg * 100 END AS variance_pct,
       coalesce(CASE WHEN rolling_avg > 0 THEN abs(headcount - rolling_avg) / rolling_avg * 100 END
                > {GATE_THRESHOLD_PCT}, false) AS is_anomaly
FROM r
""",
}
