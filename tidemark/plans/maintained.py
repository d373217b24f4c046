"""Silver and gold kept up to date by period (§2.12, T3, Q2, A1-A5, V1, M1-M4).

Every table that has periods is stored by period, and a run writes only the
partitions that can differ: those that new files or restatements touch, and
those that a change elsewhere reaches. The rest of the tables are small sums of
such partitions. All of it becomes visible at once (``sources.manifest``).

What reaches other periods, and how a run finds it without reading them:

* a *dimension* is replayed from the earliest touched period; movements dated
  from there on are derived anew from its versions, earlier ones cannot change;
* an employee who becomes known brings in payroll lines that were left out: a
  table of such lines' keys by period (``payroll_orphans``) says where, and one
  of the line periods in each landing folder (``payroll_landed``) what to open;
* a key that arrives cures log entries that missed it: the log itself is the
  index from the missing key to its periods. Keys are kept by period
  (``keys_*``), so those that a restatement removes are found too; only for
  these a column of the referring table is searched;
* a contract, role or department that changes for an employee moves the counts
  of the periods that have the employee.

Gold is formed of *states*, counts and sums by period and by the ids that gold is
joined on, so a renamed department changes no state. A period's state is
replaced as a whole, which is what retraction comes to; minimum and maximum are
taken over states, so a withdrawn extreme leaves no trace.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import marts
from tidemark.operators.gate import headcount_by_period
from tidemark.operators.scd2 import current
from tidemark.sources import manifest as mf
from tidemark.sources.rules import Rule, RuleSet


def is_in(column: str, values: Iterable[str | None]):
    """Whether a column is among values, null being one like any other."""
    values = list(values)
    named = [v for v in values if v is not None]
    hit = F.coalesce(F.col(column).isin(*named), F.lit(False)) if named else F.lit(False)
    return hit | F.col(column).isNull() if None in values else hit


def distinct_values(df: DataFrame, column: str) -> set[str | None]:
    """Distinct periods of some rows: one per month or day, so few."""
    return {r[0] for r in df.select(column).distinct().collect()}


@dataclass
class Update:
    """The tables of a run that is being formed over those of the last one."""

    spark: SparkSession
    root: str
    version: str
    before: mf.Manifest
    tables: dict

    def read(self, name: str) -> DataFrame:
        return mf.read_entry(self.spark, self.tables[name])

    def was(self, name: str) -> DataFrame | None:
        entry = self.before.tables.get(name)
        return None if entry is None else mf.read_entry(self.spark, entry)

    def is_new(self, name: str) -> bool:
        return "parts" not in self.before.tables.get(name, {})

    def put(self, name: str, df: DataFrame, periods: Iterable[str | None], by: Sequence[str] = ("period",)) -> None:
        """Replace the partitions of ``periods`` (or of tuples for several
        columns); a table that is not stored by period yet is written whole."""
        values = [v if isinstance(v, tuple) else (v,) for v in periods]
        entry = None if self.is_new(name) else self.before.tables[name]
        if entry is not None and not values:
            self.tables[name] = entry
            return
        self.tables[name] = mf.replace_parts(df, entry, f"{self.root}/silver/{name}", self.version, by, values)

    def written(self, name: str, periods: Iterable[str | None]) -> DataFrame:
        """The partitions of ``periods`` as they are now."""
        return mf.read_parts(self.spark, self.tables[name], [(p,) for p in periods])


# Keys and what refers to them --------------------------------------------------


def rules_text(rules: RuleSet) -> str:
    """The rules a log was made with; a log made with others is made anew."""
    return json.dumps({e: [asdict(r) for r in rs] for e, rs in rules.entities.items()}, sort_keys=True)


def references(rules: RuleSet) -> list[tuple[str, Rule]]:
    return [(ent, r) for ent in rules.entities for r in rules.entity_rules(ent) if r.kind == "referential"]


def update_keys(up: Update, bronze: dict[str, DataFrame], rules: RuleSet, touched: dict[str, set]) -> dict[tuple[str, str], tuple]:
    """The referenced keys by period; per reference the keys that came and went."""
    changed = {}
    for ent, column in sorted({(r.ref, r.ref_key) for _, r in references(rules) if r.ref in bronze}):
        name = f"keys_{ent}_{column}"
        periods = touched[ent]
        is_new = up.is_new(name)
        rows = bronze[ent] if is_new else bronze[ent].where(is_in("_landed", periods))
        keys = rows.where(F.col(column).isNotNull()).select(F.col(column).alias("key"), F.col("_landed").alias("period")).distinct()
        former = None if is_new else mf.read_parts(up.spark, up.before.tables[name], [(p,) for p in periods])
        up.put(name, keys, periods)
        if is_new:
            changed[ent, column] = None, None
            continue
        came = up.written(name, periods).select("key").distinct().join(up.was(name).select("key"), "key", "left_anti")
        went = former.select("key").distinct().join(up.read(name).select("key"), "key", "left_anti")
        changed[ent, column] = came, went
    return changed


def update_log(up: Update, bronze: dict[str, DataFrame], headcount: DataFrame, rules: RuleSet, touched: dict[str, set],
               log_of: Callable) -> None:
    """The quality log by entity and period: touched periods, and those that a key
    which came or went reaches. ``log_of(bronze, headcount, rules, refs)`` gives the
    log of some rows."""
    changed = update_keys(up, bronze, rules, touched)
    name = "data_quality_log"
    if up.before.notes.get("rules") != rules_text(rules):
        up.before.tables.pop(name, None)
    if up.is_new(name):
        periods = None
    else:
        periods = {ent: set(touched.get(ent, ())) for ent in rules.entities}
        old = up.was(name)
        for ent, r in references(rules):
            came, went = changed.get((r.ref, r.ref_key), (None, None))
            if came is None or ent not in bronze:
                continue
            missed = old.where((F.col("entity") == ent) & (F.col("field") == r.field) & (F.col("rule") == r.rule))
            periods[ent] |= distinct_values(missed.join(came, F.col("actual_value") == F.col("key"), "left_semi"), "period")
            if not went.isEmpty():
                periods[ent] |= distinct_values(bronze[ent].join(went, F.col(r.field) == F.col("key"), "left_semi"), "_landed")
    rows = bronze if periods is None else {e: df.where(is_in("_landed", periods.get(e, ()))) for e, df in bronze.items()}
    head = headcount if periods is None else headcount.where(is_in("period", periods.get("employees", ())))
    refs: dict[str, DataFrame] = {}
    for ent, column in changed:
        keys = up.read(f"keys_{ent}_{column}").select(F.col("key").alias(column)).distinct()
        refs[ent] = keys if ent not in refs else refs[ent].unionByName(keys, allowMissingColumns=True)
    pairs = [] if periods is None else [(e, p) for e, ps in periods.items() for p in sorted(ps, key=str)]
    up.put(name, log_of(rows, head, rules, refs), pairs, ["entity", "period"])


# Facts -------------------------------------------------------------------------


def update_payroll(up: Update, bronze: DataFrame, periods: set, landed: set, fact_of: Callable) -> None:
    """Payroll lines of known employees, and the keys of those left out. A period
    here is the line's own; an empty one is none. ``payroll_landed`` has the line
    periods of each landing folder, so that only folders with touched ones are read."""
    people = up.read("dim_employees").select("employee_id").distinct()
    lines = bronze.withColumn("period", F.nullif("period", F.lit("")))
    folders = lines if up.is_new("payroll_landed") else lines.where(is_in("_landed", landed))
    up.put("payroll_landed", folders.select("period", F.col("_landed").alias("landed")).distinct(), landed, ["landed"])
    touched = set(periods)
    if not up.is_new("fact_payroll"):
        former = up.was("dim_employees").select("employee_id").distinct()
        came, went = people.join(former, "employee_id", "left_anti"), former.join(people, "employee_id", "left_anti")
        touched |= distinct_values(up.was("payroll_orphans").join(came, "employee_id", "left_semi"), "period")
        if not went.isEmpty():
            touched |= distinct_values(up.was("fact_payroll").join(went, "employee_id", "left_semi"), "period")
    touched = {p or None for p in touched}
    rows = lines
    if not up.is_new("fact_payroll"):
        folder = up.read("payroll_landed").where(is_in("period", touched))
        rows = lines.where(is_in("_landed", distinct_values(folder, "landed")) & is_in("period", touched))
    up.put("fact_payroll", fact_of(rows, people), touched)
    orphans = rows.where(F.col("employee_id").isNotNull()).select("employee_id", "period").distinct()
    up.put("payroll_orphans", orphans.join(people, "employee_id", "left_anti").select("employee_id", "period"), touched)


def update_movements(up: Update, moves: DataFrame, since: str | None, existing: Iterable[str]) -> None:
    """Movements dated from ``since`` on stand for the stored ones (None: nothing
    touched). A period that has no rows any more may still have movements stored."""
    name = "fact_workforce_movements"
    if up.is_new(name) or since is None:
        up.put(name, moves, [])
        return
    stored = {dict(p.split("=", 1) for p in part.split("/"))["period"] for part in up.before.tables[name]["parts"]}
    later = {p for p in stored | set(existing) if p >= since}
    up.put(name, moves.where(F.col("period") >= since), later)


# States of gold ------------------------------------------------------------------


def _holding(fact: DataFrame, key: str, changed: DataFrame) -> set:
    return set() if changed.isEmpty() else distinct_values(fact.join(changed, key, "left_semi"), "period")


def _differs(now: DataFrame, former: DataFrame, key: str) -> DataFrame:
    """Keys whose rows, taken together, are not the same in both."""
    counted = [df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")) for df in (now, former)]
    return counted[0].exceptAll(counted[1]).select(key).unionByName(counted[1].exceptAll(counted[0]).select(key)).distinct()


def headcount_states(fact: DataFrame, contracts: DataFrame) -> DataFrame:
    """Active employees by period, department, role, contract type and band."""
    active = fact.where(F.col("termination_date").isNull())
    return active.join(contracts, "employee_id", "left").groupBy(
        "period", "department_id", "role_id", "contract_type", "tenure_band").agg(F.count("employee_id").alias("n"))


def salary_states(fact: DataFrame, employees: DataFrame) -> DataFrame:
    """Salaries by period and the employee's current role and department."""
    return fact.join(employees, "employee_id", "left").groupBy("period", "role_id", "department_id").agg(
        F.count("employee_id").alias("n"), F.count("salary").alias("n_salary"), F.sum("salary").alias("total"),
        F.min("salary").alias("least"), F.max("salary").alias("most"))


def movement_states(moves: DataFrame) -> DataFrame:
    return moves.groupBy("period", "event_type", "from_department_id", "department_id").agg(F.count("employee_id").alias("n"))


def update_states(up: Update, touched: dict[str, set], since: str | None, contracts_of: Callable) -> None:
    contracts, employees = contracts_of(up.read("dim_contracts")), current(up.read("dim_employees")).select("employee_id", "role_id", "department_id")
    head, comp = set(touched["employees"]), set(touched["compensation"])
    if not up.is_new("headcount_states"):
        head |= _holding(up.read("fact_headcount"), "employee_id", _differs(contracts, contracts_of(up.was("dim_contracts")), "employee_id"))
        former = current(up.was("dim_employees")).select("employee_id", "role_id", "department_id")
        comp |= _holding(up.read("fact_compensation"), "employee_id", _differs(employees, former, "employee_id"))

    def some(fact: str, states: str, periods: set) -> DataFrame:
        return up.read(fact) if up.is_new(states) else up.written(fact, periods)

    up.put("headcount_states", headcount_states(some("fact_headcount", "headcount_states", head), contracts), head)
    up.put("salary_states", salary_states(some("fact_compensation", "salary_states", comp), employees), comp)
    entry = up.before.tables.get("movement_states")
    moves = up.read("fact_workforce_movements")
    if entry is None or since is None:
        up.put("movement_states", movement_states(moves), [])
    else:
        parts = {p.split("=", 1)[1] for t in (entry, up.tables["fact_workforce_movements"]) for p in t["parts"]}
        later = {p for p in parts if p >= since}
        up.put("movement_states", movement_states(up.written("fact_workforce_movements", later)), later)


def update_counts(up: Update, periods: set) -> None:
    """Headcount by period, which is all that the gate reads."""
    fact = up.read("fact_headcount") if up.is_new("headcount_counts") else up.written("fact_headcount", periods)
    up.put("headcount_counts", headcount_by_period(fact, "employee_id", "period", F.col("termination_date").isNull()), periods)


def gold_of_states(head: DataFrame, salaries: DataFrame, moves: DataFrame, dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A1-A5 from their states; equal to the marts over all facts."""
    dept = current(dims["departments"]).select("department_id", F.col("name").alias("department_name"))
    roles = current(dims["job_roles"]).select("role_id", "band", "job_family")
    named = head.join(dept, "department_id", "left")
    by = ["period", "department_id", "department_name", "contract_type", "band", "tenure_band"]
    monthly = named.join(roles.select("role_id", "band"), "role_id", "left").groupBy(*by).agg(F.sum("n").alias("employee_count"))
    banded = named.where(F.col("tenure_band").isNotNull()).groupBy(
        "period", "department_id", "department_name", "contract_type", "tenure_band").agg(F.sum("n").alias("employee_count"))
    pay = salaries.join(roles, "role_id", "left").join(dept, "department_id", "left").groupBy("band", "job_family", "department_name").agg(
        F.sum("n").alias("employee_count"),
        (F.sum("total").cast("decimal(30,2)") / F.sum("n_salary")).cast("decimal(22,6)").alias("avg_salary"),
        F.min("least").alias("min_salary"), F.max("most").alias("max_salary"))
    left = dept.select(F.col("department_id").alias("from_department_id"), "department_name")
    gone = moves.where("event_type = 'TERMINATION'").join(left, "from_department_id", "left").groupBy(
        "period", F.col("from_department_id").alias("department_id"), "department_name").agg(F.sum("n").alias("termination_count"))
    from_, to = (dept.select(F.col("department_id").alias(k), F.col("department_name").alias(n))
                 for k, n in (("from_department_id", "from_department_name"), ("department_id", "to_department_name")))
    moved = moves.join(from_, "from_department_id", "left").join(to, "department_id", "left").groupBy(
        "period", "event_type", "from_department_name", "to_department_name").agg(F.sum("n").alias("movement_count"))
    return {"headcount_monthly": monthly, "attrition_summary": gone, "compensation_bands": pay,
            "workforce_movements": moved, "tenure_bands": marts.with_share(banded)}

