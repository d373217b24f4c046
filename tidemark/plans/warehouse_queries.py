"""The whole warehouse over the given tables, and operators that other plans build
on: mergeable distinct counts and ranks as data.

``warehouse_chain`` lands the tables as the HR entities, year by year in three
runs (one year late, files sent again, a restatement between runs), and returns
rows of several of its tables. Entities are derived by fixed rules:

* employees: a customer in each year they order in; their last order of the year
  gives department (priority) and role (status);
* contracts and compensation: a row with each employee row;
* payroll: a line for every order, in the month of the order.

Some rows are made bad, so that every rule of the rules file has something to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.periods import period_of
from tidemark.operators import quality as dq
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.distinct import key_bitmaps, merged_counts
from tidemark.operators.order import ranked
from tidemark.plans.hr import restate_bronze, run_warehouse
from tidemark.plans.quality_queries import ORACLE as QUALITY_ORACLE
from tidemark.plans.quality_queries import q_dq_log
from tidemark.plans.source_tables import table
from tidemark.session import scratch_dir

# Which customers and orders are made bad.
NO_HIRE, EARLY_END, NO_KEY, BAD_SALARY, STRANGE_PAYER, ENDED = 41, 37, 43, 29, 23, 31


def _entities(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The six landing entities with the year they land in."""
    orders = table(spark, d, "orders").where("o_custkey is not null and o_orderdate is not null").withColumn(
        "year", F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-01")))
    last = latest_per_key(orders, ["o_custkey", "year"], ["o_orderdate", "o_orderkey"])
    hired = orders.groupBy("o_custkey").agg(F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("hired"))
    staff = last.join(hired, "o_custkey")
    key = F.col("o_custkey")
    text = F.concat(F.lit("C"), key.cast("string"))
    employees = staff.select(
        F.when(~((key % NO_KEY == 0) & (F.col("year") == "1995-01")), text).alias("employee_id"),
        F.when(key % NO_HIRE != 0, F.col("hired")).alias("hire_date"),
        F.when(key % EARLY_END == 0, F.lit("1980-01-01")).when(key % ENDED == 0, F.lit("2030-01-01")).alias("termination_date"),
        F.concat(F.lit("D"), F.substring("o_orderpriority", 1, 1)).alias("department_id"),
        F.concat(F.lit("R"), F.col("o_orderstatus")).alias("role_id"), "year")
    years = orders.select("year", "o_orderpriority", "o_orderstatus").distinct()
    every = orders.select("year").distinct()
    departments = years.select(F.concat(F.lit("D"), F.substring("o_orderpriority", 1, 1)).alias("department_id"),
                               F.col("o_orderpriority").alias("name")).distinct().crossJoin(F.broadcast(every))
    roles = years.select(F.concat(F.lit("R"), F.col("o_orderstatus")).alias("role_id"), F.concat(F.lit("band "), "o_orderstatus").alias("band"),
                         F.lit("sales").alias("job_family")).distinct().crossJoin(F.broadcast(every))
    contracts = staff.select(F.concat(F.lit("K"), key.cast("string")).alias("contract_id"), text.alias("employee_id"),
                             F.when(key % 3 == 0, F.lit("PERMANENT")).otherwise(F.lit("TEMP")).alias("contract_type"),
                             F.lit("1990-01-01").alias("start_date"), "year")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    compensation = staff.select(text.alias("employee_id"), F.when(key % BAD_SALARY == 0, F.lit("n/a")).otherwise(price).alias("salary"),
                                F.lit("EUR").alias("currency"), "year")
    payroll = orders.select(F.when(F.col("o_orderkey") % STRANGE_PAYER == 0, F.concat(F.lit("X"), key.cast("string"))).otherwise(text).alias("employee_id"),
                            period_of("o_orderdate").alias("period"), price.alias("gross_pay"), F.lit("0").alias("deductions"),
                            price.alias("net_pay"), "year")
    return {"employees": employees, "departments": departments, "job_roles": roles, "contracts": contracts,
            "compensation": compensation, "payroll_events": payroll}


def _land(rows: DataFrame, landing: str, entity: str, years: list[str], name: str = "") -> None:
    """Year by year into ``<landing>/<year><name>/<entity>``: folders of a period."""
    for year in years:
        rows.where(F.col("year") == year).drop("year").write.mode("append").json(f"{landing}/{year}{name}/{entity}")


def q_warehouse_chain(spark: SparkSession, d: str) -> DataFrame:
    """§2.12: three incremental runs and a restatement; headcounts, quality log,
    movements, payroll, salaries, employee versions and the audit, as rows
    (part, period, a, b, c, n)."""
    root = scratch_dir(spark, "chain")
    landing, out, fixes = f"{root}/landing", f"{root}/warehouse", f"{root}/fixes"
    entities = {}
    for name, df in _entities(spark, d).items():  # written once; each run lands some of it
        df.write.parquet(f"{root}/source/{name}")
        entities[name] = spark.read.parquet(f"{root}/source/{name}")
    years = sorted(r[0] for r in entities["employees"].select("year").distinct().collect())
    late, half = years[len(years) // 2], len(years) // 2 + 1
    res = None
    for run, some in enumerate(([y for y in years[:half] if y != late], years[half:], [late])):
        for name, df in entities.items():
            _land(df, landing, name, some)
        if run == 2:  # a re-sent file changes nothing
            _land(entities["compensation"], landing, "compensation", years[:1])
        if some:
            res = run_warehouse(spark, landing, out, gate=False, incremental=True)
        if run == 0 and some:  # department D1 is renamed in the first year, from then on
            renamed = entities["departments"].where("department_id = 'D1'").withColumn("name", F.lit("restated"))
            _land(renamed, fixes, "departments", years[:1])
            restate_bronze(spark, res.tables["bronze_departments"], fixes, "departments", {"department_id": "D1"}, years[0], years[0], "me", out)
    none = F.lit(None).cast("string")

    def rows(part: str, df: DataFrame, period, a, b, c, n) -> DataFrame:
        return df.select(F.lit(part).alias("part"), period.alias("period"), a.alias("a"), b.alias("b"), c.alias("c"), n.cast("long").alias("n"))

    col = F.col
    log = res.read(spark, "data_quality_log").groupBy("period", "entity", "field", "severity").agg(F.count(F.lit(1)).alias("n"))
    pay = res.read(spark, "fact_payroll").groupBy("period").agg(F.sum("gross_pay").alias("total"), F.count(F.lit(1)).alias("n"))
    moves = res.read(spark, "workforce_movements").groupBy("period", "event_type").agg(F.sum("movement_count").alias("n"))
    head = res.read(spark, "headcount_monthly")
    comp = res.read(spark, "compensation_bands")
    dims = res.read(spark, "dim_employees").groupBy("__START_AT", "__END_AT").agg(F.count(F.lit(1)).alias("n"))
    depts = res.read(spark, "dim_departments").where("name = 'restated'")
    audit = spark.read.parquet(f"{out}/silver/restatement_audit_log")
    parts = [
        rows("headcount", head, col("period"), col("department_name"), F.concat_ws("/", "contract_type", "band"), col("tenure_band"), col("employee_count")),
        rows("log", log, col("period"), col("entity"), col("field"), col("severity"), col("n")),
        rows("payroll", pay, col("period"), col("total").cast("string"), none, none, col("n")),
        rows("movements", moves, col("period"), col("event_type"), none, none, col("n")),
        rows("compensation", comp, none, col("band"), col("department_name"),
             F.concat_ws("/", col("min_salary").cast("string"), col("max_salary").cast("string")), col("employee_count")),
        rows("versions", dims, col("__START_AT"), col("__END_AT"), none, none, col("n")),
        rows("restated", depts, col("__START_AT"), col("__END_AT"), col("department_id"), none, F.lit(1)),
        rows("audit", audit, col("start_period"), col("employee_id"), col("triggered_by"), col("status"), col("rows_removed") + 10 * col("rows_added")),
    ]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def q_distinct_merged(spark: SparkSession, d: str) -> DataFrame:
    """Users by month and year, merged from the bitmaps of single days."""
    events = table(spark, d, "events").where("ts is not null").select("user_id", period_of("ts", "yyyy-MM-dd").alias("day"))
    days = key_bitmaps(events, "user_id", ["day"])
    month, year = (days.withColumn("period", F.substring("day", 1, n)) for n in (7, 4))
    return merged_counts(month, ["period"]).unionByName(merged_counts(year, ["period"]))


def q_dq_ranked(spark: SparkSession, d: str) -> DataFrame:
    """O1, O3: the quality log in its order of review, the rank in every row."""
    log = q_dq_log(spark, d)
    order = [dq.severity_rank().desc(), F.col("entity"), F.col("field"), F.col("record_key").asc_nulls_first(), F.col("actual_value").asc_nulls_first()]
    return ranked(log, order).select("rank", "severity", "entity", "field", "record_key", "actual_value")


QUERIES = {"warehouse_chain": q_warehouse_chain, "distinct_merged": q_distinct_merged, "dq_ranked": q_dq_ranked}

_TENURE = """CASE WHEN days IS NULL OR days < 0 THEN NULL WHEN days < 365 THEN '0-1 year' WHEN days < 1095 THEN '1-3 years'
       WHEN days < 1825 THEN '3-5 years' ELSE '5+ years' END"""

ORACLE = {
    "warehouse_chain": f"""
WITH o AS (
  SELECT *, strftime(o_orderdate, '%Y') || '-01' AS year FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL),
years AS (SELECT DISTINCT year, dense_rank() OVER (ORDER BY year) AS i FROM o),
staff AS (
  SELECT l.*, h.hired, 'C' || l.o_custkey AS who FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey, year ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM o) l
  JOIN (SELECT o_custkey, strftime(min(o_orderdate), '%Y-%m-%d') AS hired FROM o GROUP BY 1) h USING (o_custkey) WHERE rn = 1),
emp AS (
  SELECT CASE WHEN NOT (o_custkey % {NO_KEY} = 0 AND year = '1995-01') THEN who END AS employee_id,
         CASE WHEN o_custkey % {NO_HIRE} <> 0 THEN hired END AS hire_date,
         CASE WHEN o_custkey % {EARLY_END} = 0 THEN '1980-01-01' WHEN o_custkey % {ENDED} = 0 THEN '2030-01-01' END AS ended,
         'D' || o_orderpriority[1] AS dept, o_orderpriority AS dept_name, 'R' || o_orderstatus AS role, 'band ' || o_orderstatus AS band, year,
         CASE WHEN o_custkey % 3 = 0 THEN 'PERMANENT' ELSE 'TEMP' END AS contract, o_custkey, o_totalprice
  FROM staff),
-- termination before hire is nulled; a termination in the future stays
good AS (
  SELECT *, CASE WHEN ended < hire_date THEN NULL ELSE ended END AS terminated,
         date_diff('day', CAST(hire_date AS DATE), CAST(year || '-01' AS DATE)) AS days
  FROM emp WHERE employee_id IS NOT NULL),
head AS (SELECT *, {_TENURE} AS tenure FROM good),
-- the restated name of D1 holds in the first year, so the current one is the plain one
-- (with a single year the restated one is current)
last_year AS (SELECT max(year) AS y, min(year) AS first_y, count(DISTINCT year) AS n FROM o),
names AS (SELECT DISTINCT dept, CASE WHEN dept = 'D1' AND (SELECT n FROM last_year) = 1 THEN 'restated' ELSE dept_name END AS name FROM emp),
-- contracts and employees that are current: those of the last year
open_contract AS (SELECT 'C' || o_custkey AS employee_id, contract FROM emp WHERE year = (SELECT y FROM last_year)),
now AS (SELECT * FROM good WHERE year = (SELECT y FROM last_year)),
steps AS (SELECT y.year, lead(y.year) OVER (ORDER BY y.year) AS next FROM (SELECT DISTINCT year FROM good) y),
seen AS (
  SELECT g.employee_id, g.year, g.dept, g.role, g.hire_date, g.terminated, s.next,
         lag(g.year) OVER w AS before, lag(g.dept) OVER w AS dept_before, lag(g.role) OVER w AS role_before, lead(g.year) OVER w AS after,
         lag(coalesce(g.hire_date, '') || '|' || coalesce(g.terminated, '') || '|' || g.dept || '|' || g.role) OVER w AS state_before,
         coalesce(g.hire_date, '') || '|' || coalesce(g.terminated, '') || '|' || g.dept || '|' || g.role AS state
  FROM good g JOIN steps s USING (year) WINDOW w AS (PARTITION BY g.employee_id ORDER BY g.year)),
edges AS (
  SELECT *, before IS NULL OR state <> state_before OR before <> (SELECT max(year) FROM steps p WHERE p.next = seen.year) AS opens FROM seen),
versions AS (
  SELECT employee_id, min(year) AS begun, CASE WHEN count(*) = count(next) THEN max(next) END AS closed FROM (
    SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY employee_id ORDER BY year) AS v FROM edges) e
  GROUP BY employee_id, v),
moves AS (
  SELECT year AS period, 'HIRE' AS kind FROM seen WHERE before IS NULL
  UNION ALL SELECT year, 'TRANSFER' FROM seen WHERE before IS NOT NULL AND (dept <> dept_before OR role <> role_before)
  UNION ALL SELECT next, 'TERMINATION' FROM seen WHERE next IS NOT NULL AND (after IS NULL OR after <> next)),
pay AS (
  SELECT CASE WHEN o_orderkey % {STRANGE_PAYER} = 0 THEN 'X' ELSE 'C' END || o_custkey AS employee_id, strftime(o_orderdate, '%Y-%m') AS period,
         CAST(o_totalprice AS DECIMAL(18,2)) AS gross, year FROM o),
comp AS (SELECT 'C' || o_custkey AS employee_id, CAST(o_totalprice AS DECIMAL(18,2)) AS salary, year FROM emp WHERE o_custkey % {BAD_SALARY} <> 0),
log AS (
  SELECT year AS period, 'employees' AS entity, 'employee_id' AS field, 'CRITICAL' AS severity FROM emp WHERE employee_id IS NULL
  UNION ALL SELECT year, 'employees', 'hire_date', 'ERROR' FROM emp WHERE employee_id IS NOT NULL AND hire_date IS NULL
  UNION ALL SELECT year, 'employees', 'termination_date', 'ERROR' FROM emp
            WHERE employee_id IS NOT NULL AND NOT coalesce(ended IS NULL OR ended > hire_date, false)
  UNION ALL SELECT year, 'employees', 'tenure_days', 'ERROR' FROM good WHERE days < 0
  UNION ALL SELECT year, 'payroll_events', 'employee_id', 'ERROR' FROM pay WHERE employee_id NOT IN (SELECT employee_id FROM good)
  UNION ALL SELECT year, 'payroll_events', 'gross_pay', 'WARNING' FROM pay WHERE NOT gross > 0
  UNION ALL SELECT year, 'compensation', 'salary', 'ERROR' FROM emp WHERE o_custkey % {BAD_SALARY} = 0)
SELECT 'headcount' AS part, h.year AS period, n.name AS a, concat_ws('/', c.contract, h.band) AS b, h.tenure AS c, count(*) AS n
FROM head h JOIN names n ON n.dept = h.dept LEFT JOIN open_contract c USING (employee_id)
WHERE h.terminated IS NULL GROUP BY h.year, n.name, c.contract, h.band, h.tenure
UNION ALL SELECT 'log', period, entity, field, severity, count(*) FROM log GROUP BY 2, 3, 4, 5
UNION ALL SELECT 'payroll', period, CAST(sum(gross) AS VARCHAR), NULL, NULL, count(*) FROM pay
          WHERE employee_id IN (SELECT employee_id FROM good) AND gross >= 0 GROUP BY 2
UNION ALL SELECT 'movements', period, kind, NULL, NULL, count(*) FROM moves GROUP BY 2, 3
UNION ALL SELECT 'compensation', NULL, g.band, n.name, concat_ws('/', CAST(min(m.salary) AS VARCHAR), CAST(max(m.salary) AS VARCHAR)), count(*)
          FROM comp m LEFT JOIN now g USING (employee_id) LEFT JOIN names n ON n.dept = g.dept WHERE m.salary > 0 GROUP BY g.band, n.name
UNION ALL SELECT 'versions', begun, closed, NULL, NULL, count(*) FROM versions GROUP BY 2, 3
UNION ALL SELECT 'restated', first_y, CASE WHEN n > 1 THEN (SELECT min(year) FROM o WHERE year > first_y) END, 'D1', NULL, 1 FROM last_year
UNION ALL SELECT 'audit', first_y, 'department_id=D1', 'me', 'SUCCESS', 11 FROM last_year
""",
    "distinct_merged": """
SELECT strftime(ts, '%Y-%m') AS period, count(DISTINCT user_id) AS n_distinct FROM events WHERE ts IS NOT NULL GROUP BY 1 HAVING count(user_id) > 0
UNION ALL
SELECT strftime(ts, '%Y'), count(DISTINCT user_id) FROM events WHERE ts IS NOT NULL GROUP BY 1 HAVING count(user_id) > 0
""",
    "dq_ranked": f"""
SELECT row_number() OVER (ORDER BY CASE severity WHEN 'CRITICAL' THEN 3 WHEN 'ERROR' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END DESC, entity, field,
                          record_key NULLS FIRST, actual_value NULLS FIRST) AS rank,
       severity, entity, field, record_key, actual_value
FROM ({QUALITY_ORACLE['dq_log']}) l
""",
}
