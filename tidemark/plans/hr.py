"""The HR snapshot warehouse, stage by stage (§2.12 of the survey):

landing JSON -> bronze (streaming, rescue) -> silver (type-2 dimensions,
facts, movements, quality log) -> headcount gate -> gold marts -> steward
review. Each stage is a function over DataFrames; ``run_warehouse`` calls
them in order, writes every table to a fresh folder under ``out_root`` and
stops (raises) when the gate flags the latest period.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.periods import period_from_path
from tidemark.operators import marts
from tidemark.operators import quality as dq
from tidemark.operators.calendar import dim_date
from tidemark.operators.dedup import drop_null_keys, latest_per_key, rows_of_newest, rows_of_newest_in_window
from tidemark.operators.facts import compensation_fact, payroll_fact, repair_before, with_tenure
from tidemark.operators.gate import assert_no_anomaly, gate_of_counts, headcount_gate
from tidemark.operators.movements import movements, movements_from_history
from tidemark.operators.scd2 import current, replay_snapshots
from tidemark.functions.periods import normalize_period
from tidemark.operators.restate import audit_row, check_range
from tidemark.plans import maintained
from tidemark.plans.incremental import periods_of, update_dimension
from tidemark.plans.maintained import Update, distinct_values, is_in
from tidemark.sources import manifest as mf
from tidemark.sources.landing import ENTITY_FIELDS, NEWEST, PARTITIONS, read_bronze, read_landing
from tidemark.sources.rules import RuleSet
from tidemark.sources.tables import append_once, table_exists, write_table
from tidemark.streaming.ingest import ingest_to_bronze

# Natural key of each dimension entity.
DIM_KEYS = {
    "departments": ["department_id"],
    "job_roles": ["role_id"],
    "employees": ["employee_id"],
    "contracts": ["employee_id", "contract_type", "start_date"],
}

RULES_PATH = os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(
    os.path.abspath(__file__)))), "config", "quality_rules.json")


# What identifies a row of an entity within a period.
ROW_KEYS = {**DIM_KEYS, "compensation": ["employee_id"], "payroll_events": ["employee_id", "period"]}


def with_period(bronze: DataFrame) -> DataFrame:
    """The period of each row's landing folder, which bronze is partitioned by."""
    landed = F.col("_landed") if "_landed" in bronze.columns else period_from_path("_source_file_name")
    return bronze.withColumn("period", landed).drop("_landed")


def snapshots(bronze: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key and period: period from the file path, the row of the
    newest file wins, so a re-sent file does not double rows."""
    return latest_per_key(with_period(bronze), keys + ["period"], NEWEST)


def employee_snapshots(bronze_employees: DataFrame) -> DataFrame:
    """D4 for employees: null keys dropped, termination before hire nulled."""
    return repair_before(snapshots(bronze_employees, ["employee_id"]), "termination_date",
                         "hire_date")


def entity_snapshots(bronze: DataFrame, entity: str) -> DataFrame:
    return employee_snapshots(bronze) if entity == "employees" else snapshots(
        bronze, DIM_KEYS[entity])


def tracked_of(entity: str) -> list[str]:
    return [c for c in ENTITY_FIELDS[entity] if c not in DIM_KEYS[entity]]


def periods_with_keys(bronze: DataFrame, keys: list[str]) -> DataFrame:
    """The raw period column of the rows that have a key."""
    return with_period(drop_null_keys(bronze, keys)).select("period")


def dimension(bronze: DataFrame, entity: str) -> DataFrame:
    """Type-2 dimension of an entity from its per-period snapshots (D3)."""
    return replay_snapshots(entity_snapshots(bronze, entity), DIM_KEYS[entity], tracked_of(entity),
                            "period", periods=periods_with_keys(bronze, DIM_KEYS[entity]))


def fact_headcount(emp_snaps: DataFrame) -> DataFrame:
    """D5."""
    f = with_tenure(emp_snaps, "period", "hire_date")
    return f.select("employee_id", "department_id", "role_id", "period", "period_date",
                    "hire_date", "termination_date", "tenure_days_raw", "tenure_days",
                    "tenure_band", "_ingested_at", "_source_file_name")


def fact_payroll(bronze_payroll: DataFrame, bronze_employees: DataFrame) -> DataFrame:
    """Payroll lines of known employees with parseable, non-negative pay.

    Payroll has no natural key, so every valid line is kept; of files that have
    valid lines of an employee and period, only the newest counts (re-sent)."""
    lines = bronze_payroll.withColumn("period", F.nullif("period", F.lit("")))
    valid = payroll_fact(lines, bronze_employees.where(F.col("employee_id").isNotNull()),
                         "employee_id", ["employee_id", "period", "gross_pay", "deductions",
                                         "net_pay", *NEWEST])
    # Lines of a known employee and a period are few, as the period is a month of pay.
    return rows_of_newest_in_window(valid, ["employee_id", "period"], NEWEST).drop("_file_modified_at")


def fact_compensation(bronze_comp: DataFrame) -> DataFrame:
    """Per employee and period the newest row with a valid salary, late
    column, band."""
    valid = compensation_fact(with_period(bronze_comp), "employee_id", "salary",
                              ["employee_id", "salary", "currency", "effective_date", "period", *NEWEST],
                              optional=["compensation_category"])
    return latest_per_key(valid, ["employee_id", "period"], NEWEST).drop("_file_modified_at")


def quality(bronze: dict[str, DataFrame], headcount: DataFrame, rules: RuleSet,
            refs: dict[str, DataFrame] | None = None) -> DataFrame:
    """Q2 over every entity that the rules name: the rows of the newest file that
    has a key in a period (a re-sent file is judged once). Referential rules may
    name any entity; ``refs`` holds the rows that have their keys, by default all
    of ``bronze``. The tenure rule runs on the fact with the un-nulled tenure
    (so a negative tenure is actually seen)."""
    refs = bronze if refs is None else refs
    logs = []
    for ent in rules.entities:
        if ent not in bronze:
            continue
        keys = ROW_KEYS[ent]
        rows = bronze[ent]
        rows = rows_of_newest(rows, keys + ["_landed"], NEWEST)
        ids = dict(key="employee_id" if "employee_id" in rows.columns else keys[0], period="_landed",
                   ingested="_ingested_at", source="_source_file_name", key_name="employee_id")
        row_rules = [r for r in rules.entity_rules(ent) if (ent, r.field) != ("employees", "tenure_days")]
        logs.append(dq.quality_log(rows, ent, row_rules, refs=refs, **ids))
    tenure_rules = [r for r in rules.entity_rules("employees") if r.field == "tenure_days"]
    if tenure_rules:
        t = headcount.withColumn("tenure_days", F.col("tenure_days_raw"))
        logs.append(dq.quality_log(t, "employees", tenure_rules, key="employee_id",
                                   period="period", ingested="_ingested_at",
                                   source="_source_file_name", key_name="employee_id"))
    return dq.union_logs(logs) if logs else dq.empty_log(headcount.sparkSession, "employee_id")


@dataclass
class Silver:
    dims: dict[str, DataFrame]
    fact_headcount: DataFrame
    fact_payroll: DataFrame
    fact_compensation: DataFrame
    movements: DataFrame
    quality_log: DataFrame
    dim_date: DataFrame | None = None


def present_employees(head: DataFrame, end_at_termination: bool) -> DataFrame:
    """The employees a period counts as there: all listed ones or, with
    ``end_at_termination``, those whose termination date is not past."""
    if not end_at_termination:
        return head
    ended = F.try_to_date(F.substring("termination_date", 1, 10), "yyyy-MM-dd") < F.col("period_date")
    return head.where(~F.coalesce(ended, F.lit(False)))


def known_employees(bronze_employees: DataFrame) -> DataFrame:
    """Employees listed in some period: those payroll lines count for."""
    return bronze_employees.where(F.col("_landed").isNotNull())


def silver(bronze: dict[str, DataFrame], rules: RuleSet, rehire: bool = False,
           null_safe: bool = False, end_at_termination: bool = False) -> Silver:
    """``rehire``/``null_safe``: movement options (see ``movements``).
    ``end_at_termination``: an employee still listed after their termination
    date counts as gone for movements (the source keeps terminated staff in
    later snapshots, so absence alone finds few terminations)."""
    dims = {ent: dimension(bronze[ent], ent) for ent in DIM_KEYS}
    head = fact_headcount(employee_snapshots(bronze["employees"]))
    moves = movements(present_employees(head, end_at_termination), ["employee_id"], "period",
                      ["department_id", "role_id"], rehire=rehire, null_safe=null_safe,
                      periods=periods_with_keys(bronze["employees"], ["employee_id"]))
    return Silver(dims, head, fact_payroll(bronze["payroll_events"], known_employees(bronze["employees"])),
                  fact_compensation(bronze["compensation"]), moves,
                  quality(bronze, head, rules))


def current_contracts(contracts: DataFrame, one_contract_per_employee: bool = False) -> DataFrame:
    """employee_id and contract_type of the open contracts; with
    ``one_contract_per_employee`` of each employee's latest (by start date, then
    contract id)."""
    open_contracts = current(contracts)
    if one_contract_per_employee:
        open_contracts = latest_per_key(open_contracts, ["employee_id"], ["start_date", "contract_id"])
    return open_contracts.select("employee_id", "contract_type")


def gold(s: Silver, one_contract_per_employee: bool = False) -> dict[str, DataFrame]:
    """``one_contract_per_employee``: join only each employee's latest open
    contract (by start date, then contract id); by default every open
    contract is joined, so an employee with two open contracts counts twice."""
    dept = current(s.dims["departments"]).select("department_id",
                                                 F.col("name").alias("department_name"))
    contracts = current_contracts(s.dims["contracts"], one_contract_per_employee)
    roles = current(s.dims["job_roles"]).select("role_id", "band", "job_family")
    employees = current(s.dims["employees"]).select("employee_id", "role_id", "department_id")
    comp = s.fact_compensation
    return {
        "headcount_monthly": marts.headcount_monthly(
            s.fact_headcount, [(dept, "department_id"), (contracts, "employee_id"),
                               (roles.select("role_id", "band"), "role_id")]),
        "attrition_summary": marts.attrition_summary(s.movements, dept),
        "compensation_bands": marts.compensation_bands(
            comp, [(employees, "employee_id"), (roles, "role_id"), (dept, "department_id")]),
        "workforce_movements": marts.workforce_movements(
            s.movements, dept.withColumnRenamed("department_name", "name")),
        "tenure_bands": marts.tenure_bands(
            s.fact_headcount, [(dept, "department_id"), (contracts, "employee_id")]),
        "data_quality_review": dq.review(s.quality_log),
    }


@dataclass
class RunResult:
    """``tables``: every table's folder; ``read`` gives what the run published."""

    tables: dict[str, str] = field(default_factory=dict)
    gate: dict | None = None
    review: dict | None = None
    published: mf.Manifest | None = None

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return mf.read_entry(spark, self.published.tables[name])


LEDGER = "{out}/bronze/_ledger"
STARTED = "{out}/bronze/_started"


def ingest_all(spark: SparkSession, landing: str, out_root: str,
               entities=tuple(ENTITY_FIELDS), run_id: str | None = None) -> dict[str, str]:
    """Stage 1: every entity's new landing files into its bronze table, by period
    and run, and into the ledger of files.

    A run is noted as started first. One that stopped before its files were in
    the ledger is recorded by the next, from its own folders."""
    run_id = run_id or uuid.uuid4().hex
    started, ledger = STARTED.format(out=out_root), LEDGER.format(out=out_root)
    write_table(spark.createDataFrame([(run_id,)], "run_id string"), started, "append")
    paths = {}
    for ent in entities:
        paths[ent] = ingest_to_bronze(spark, landing, ent, f"{out_root}/bronze/{ent}",
                                      f"{out_root}/_checkpoints/bronze_{ent}", run_id=run_id, partition_by=PARTITIONS)
    done = mf.recorded(spark, ledger).select("run_id", "entity").distinct()
    wanted = spark.read.parquet(started).distinct().crossJoin(
        F.broadcast(spark.createDataFrame([(e,) for e in entities], "entity string")))
    for r in wanted.join(done, ["run_id", "entity"], "left_anti").collect():
        rows = read_bronze(spark, paths[r["entity"]], r["entity"]).where(F.col("_pipeline_run_id") == r["run_id"])
        mf.record_files(spark, ledger, r["entity"], r["run_id"], rows, DIM_KEYS.get(r["entity"], []))
    return paths


RESOLUTION_KEYS = ["_ingested_at", "_source_file_name", "entity", "period", "field", "employee_id"]


def record_resolutions(spark: SparkSession, out_root: str, resolutions: DataFrame) -> str:
    """V3, persisted: append steward resolutions (the match columns
    in ``RESOLUTION_KEYS`` plus ``resolved_by``,
    ``resolved_at``, ``resolution_type``); every later run applies them to
    the quality log it writes. Bronze ingest times never change, so an entry
    keeps its identity from run to run."""
    path = f"{out_root}/silver/dq_resolutions"
    cols = RESOLUTION_KEYS + ["resolved_by", "resolved_at", "resolution_type"]
    write_table(resolutions.select(*cols), path, "append")
    return path


SCOPES = "{out}/bronze/_restatements"
CORRECTIONS = "{out}/bronze/{entity}_corrections"
_SCOPE = "id string, entity string, keys string, start_period string, end_period string, at long"


def _scopes(spark: SparkSession, out_root: str) -> DataFrame:
    path = SCOPES.format(out=out_root)
    return spark.read.schema(_SCOPE).parquet(path) if table_exists(spark, path) else spark.createDataFrame([], _SCOPE)


def _scope_columns(scopes: DataFrame) -> list[list[str]]:
    """The sets of columns that restatements name: a handful, whatever their number."""
    return sorted(list(r[0]) for r in scopes.select(F.json_object_keys("keys")).distinct().collect())


def restated(spark: SparkSession, base: DataFrame, entity: str, out_root: str) -> DataFrame:
    """Bronze rows of an entity with every restatement applied (R1, on read).

    A restatement is a scope (the values of some key columns, period range, time)
    and the corrected rows. It withdraws the rows with these values in the range
    that came before it, corrections of former restatements too; rows that land
    later compete by their file's time. Only rows within the restated periods
    meet the scopes, in one anti join for each set of key columns."""
    scopes = _scopes(spark, out_root).where(F.col("entity") == entity)
    first, last = scopes.agg(F.min("start_period"), F.max("end_period")).first()
    if first is None:
        return base
    rows = base.withColumn("_at", F.unix_micros("_ingested_at"))
    corrected = CORRECTIONS.format(out=out_root, entity=entity)
    if table_exists(spark, corrected):
        rows = rows.unionByName(spark.read.schema(rows.schema).parquet(corrected))
    within = F.coalesce(F.col("_landed").between(first, last), F.lit(False))
    inside = rows.where(within)
    for columns in _scope_columns(scopes):
        mine = scopes.where(F.to_json(F.json_object_keys("keys")) == json.dumps(columns, separators=(",", ":")))
        scope = mine.select(*(F.get_json_object("keys", f"$['{c}']").alias(f"_k_{c}") for c in columns),
                            F.col("start_period").alias("_from"), F.col("end_period").alias("_to"), F.col("at").alias("_scope_at"))
        hit = F.col("_landed").between(F.col("_from"), F.col("_to")) & (F.col("_scope_at") > F.col("_at"))
        for c in columns:
            hit = hit & (F.col(c) == F.col(f"_k_{c}"))
        inside = inside.join(scope, hit, "left_anti")
    return rows.where(~within).unionByName(inside).drop("_at")


@dataclass
class Pending:
    """What landed or was restated since the last published run: the runs, and per
    entity the periods touched and those there are now."""

    ids: list[str]
    touched: dict[str, set]
    existing: dict[str, list[str]]
    payroll_periods: set


def pending(spark: SparkSession, out_root: str, done: list[str], raw: dict[str, DataFrame],
            bronze: dict[str, DataFrame]) -> Pending:
    """Found in the ledger of files; bronze is opened for restated periods and, as
    payroll lines carry their own period, for the new payroll files only.

    A run whose gate failed is not published, so its files stay pending."""
    committed = spark.createDataFrame([(r,) for r in done], "run_id string")
    files = mf.recorded(spark, LEDGER.format(out=out_root))
    fresh = files.join(committed, "run_id", "left_anti")
    new = fresh.select("run_id", "entity", "period", F.col("file").isNotNull().alias("has_file")).distinct().collect()
    scopes = [s.asDict() for s in _scopes(spark, out_root).collect()]
    open_ids = {s["id"] for s in scopes} - set(done)
    ids = {r["run_id"] for r in new} | open_ids
    held = files.where("file is not null").groupBy("entity", "period").agg(F.sum("n_keyed").alias("n_keyed")).collect()
    touched, existing, pay = {}, {}, set()
    for ent in raw:
        mine = [s for s in scopes if s["entity"] == ent]
        periods = {r["period"] for r in held if r["entity"] == ent}
        keyed = {r["period"] for r in held if r["entity"] == ent and r["n_keyed"] and r["period"] is not None}
        touched[ent] = {r["period"] for r in new if r["entity"] == ent and r["has_file"]}
        if mine:
            ranges = [(s["start_period"], s["end_period"]) for s in mine]
            in_range = F.lit(False)
            for a, b in ranges:
                in_range = in_range | F.col("_landed").between(a, b)
            rows = bronze[ent].where(in_range)
            corrected = spark.read.parquet(path) if table_exists(spark, path := CORRECTIONS.format(out=out_root, entity=ent)) else None
            if corrected is not None:
                periods |= distinct_values(corrected, "_landed")
            restated_now = {p for p in periods if p is not None and any(a <= p <= b for a, b in ranges)}
            left = distinct_values(drop_null_keys(rows, DIM_KEYS.get(ent, [])), "_landed")
            keyed = (keyed - restated_now) | left
            spans = [(s["start_period"], s["end_period"]) for s in mine if s["id"] in open_ids]
            touched[ent] |= {p for p in restated_now if any(a <= p <= b for a, b in spans)}
            if ent == "payroll_events":
                for a, b in spans:
                    pay |= distinct_values(raw[ent].where(F.col("_landed").between(a, b)), "period")
                    if corrected is not None:
                        pay |= distinct_values(corrected.where(F.col("_landed").between(a, b)), "period")
        existing[ent] = sorted(keyed)
    pay |= distinct_values(raw["payroll_events"].where(F.col("_pipeline_run_id").isin(
        [r["run_id"] for r in new if r["entity"] == "payroll_events"])), "period")
    return Pending(sorted(ids), touched, existing, pay)


def update_tables(spark: SparkSession, out_root: str, raw: dict[str, DataFrame], bronze: dict[str, DataFrame], version: str,
                  rules: RuleSet, check, one_contract_per_employee: bool = False, rehire: bool = False, null_safe: bool = False,
                  end_at_termination: bool = False) -> tuple[Update, list[str]]:
    """Form the tables of the next run from those of the last and what is pending
    (see ``plans.maintained``). Nothing is published here; ``check`` sees the
    headcounts as they would be and may raise."""
    options = json.dumps([one_contract_per_employee, rehire, null_safe, end_at_termination])
    before = mf.load(spark, f"{out_root}/_published")
    if before.notes.get("kind") != "maintained" or before.notes.get("options") != options:
        before = mf.Manifest(before.number)  # built otherwise: start from all of bronze
    todo = pending(spark, out_root, before.runs, raw, bronze)
    up = Update(spark, out_root, version, before, {})
    first = {ent: min((p for p in todo.touched[ent] if p is not None), default=None) for ent in raw}
    for ent in DIM_KEYS:
        stored = before.tables.get(f"dim_{ent}", {}).get("path")
        rows = bronze[ent] if stored is None or first[ent] is None else bronze[ent].where(F.col("_landed") >= first[ent])
        touched = sorted(p for p in todo.touched[ent] if p is not None) if stored else todo.existing[ent]
        up.tables[f"dim_{ent}"] = {"path": update_dimension(
            spark, stored, f"{out_root}/silver/dim_{ent}/v-{version}", entity_snapshots(rows, ent), DIM_KEYS[ent],
            tracked_of(ent), touched, todo.existing[ent], periods=periods_with_keys(rows, DIM_KEYS[ent]))}
    emp, comp = todo.touched["employees"] - {None}, todo.touched["compensation"]

    def rows_of(ent: str, table: str) -> DataFrame:
        return bronze[ent] if up.is_new(table) else bronze[ent].where(is_in("_landed", todo.touched[ent]))

    up.put("fact_headcount", fact_headcount(employee_snapshots(rows_of("employees", "fact_headcount"))), emp)
    maintained.update_counts(up, emp)
    check(up.read("headcount_counts"))
    up.put("fact_compensation", fact_compensation(rows_of("compensation", "fact_compensation")), comp)
    maintained.update_payroll(up, bronze["payroll_events"], todo.payroll_periods, todo.touched["payroll_events"], fact_payroll)
    if end_at_termination:  # absence depends on dates, not on versions: from all of the stored fact
        head = up.read("fact_headcount")
        moves = movements(present_employees(head, True), ["employee_id"], "period", ["department_id", "role_id"], rehire=rehire,
                          null_safe=null_safe, periods=head.select("period"))
    else:
        moves = movements_from_history(up.read("dim_employees"), ["employee_id"], ["department_id", "role_id"], rehire=rehire,
                                       null_safe=null_safe)
    maintained.update_movements(up, moves, first["employees"], todo.existing["employees"])
    maintained.update_log(up, bronze, up.read("fact_headcount"), rules, todo.touched, quality)
    maintained.update_states(up, todo.touched, first["employees"], lambda c: current_contracts(c, one_contract_per_employee))
    up.before.notes = {"kind": "maintained", "options": options,
                       "rules": maintained.rules_text(rules)}
    return up, before.runs + todo.ids


def _finish(spark: SparkSession, out_root: str, version: str, tables: dict, frames: dict[str, DataFrame], number: int, runs: list[str],
            notes: dict, res: RunResult, fact_headcount: DataFrame) -> RunResult:
    """Write what is left, and publish."""
    # The calendar has its usual years and those of every period; days are
    # appended once and never rewritten.
    first, last = fact_headcount.agg(F.min("period_date"), F.max("period_date")).first()
    years = dim_date(spark) if first is None else dim_date(
        spark, min("2018-01-01", f"{first.year:04d}-01-01"), max("2030-12-31", f"{last.year:04d}-12-31"))
    append_once(years, f"{out_root}/silver/dim_date", ["date_id"])
    tables["dim_date"] = {"path": f"{out_root}/silver/dim_date"}
    for name, df in frames.items():
        path = f"{out_root}/gold/{name}/v-{version}"
        write_table(df, path)
        tables[name] = {"path": path}
    res.published = mf.publish(spark, f"{out_root}/_published", mf.Manifest(number, tables, runs, notes))
    res.tables.update({n: e.get("path", e.get("root")) for n, e in tables.items()})
    return res


def run_warehouse(spark: SparkSession, landing: str, out_root: str,
                  rules: RuleSet | None = None, period: str | None = None,
                  gate: bool = True, one_contract_per_employee: bool = False,
                  incremental: bool = False, **silver_options) -> RunResult:
    """Bronze -> silver -> gate -> gold -> review, in that order; restatements
    recorded by ``restate_bronze`` are part of bronze as it is read.

    ``incremental=True`` forms the tables from those of the last run and what is
    pending (``update_tables``); they equal those of a full run over the same
    landing. Either way all tables are published at once, after the gate."""
    rules = rules or RuleSet.load(spark, RULES_PATH)
    res = RunResult()
    bronze_paths = ingest_all(spark, landing, out_root)
    raw = {e: read_bronze(spark, p, e) for e, p in bronze_paths.items()}
    bronze = {e: restated(spark, df, e, out_root) for e, df in raw.items()}
    res.tables.update({f"bronze_{e}": p for e, p in bronze_paths.items()})
    version = uuid.uuid4().hex[:8]

    def check(gated: DataFrame) -> None:
        if gate:
            at = gated.select(F.max("period")).first()[0] if period is None else period
            res.gate = assert_no_anomaly(gated, at)

    threshold = float(rules.threshold("headcount_variance_pct"))

    def resolved(log: DataFrame) -> DataFrame:
        resolutions = f"{out_root}/silver/dq_resolutions"
        if not table_exists(spark, resolutions):
            return log
        return dq.resolve(log, spark.read.parquet(resolutions), on=RESOLUTION_KEYS)

    if incremental:
        up, runs = update_tables(spark, out_root, raw, bronze, version, rules, lambda counts: check(gate_of_counts(
            counts, threshold_pct=threshold)), one_contract_per_employee, **silver_options)
        log = resolved(up.read("data_quality_log"))
        frames = maintained.gold_of_states(up.read("headcount_states"), up.read("salary_states"), up.read("movement_states"),
                                           {e: up.read(f"dim_{e}") for e in DIM_KEYS})
        frames["data_quality_review"] = dq.review(log)
        res.review = dq.summary(log).first().asDict()
        return _finish(spark, out_root, version, up.tables, frames, up.before.number, runs, up.before.notes, res, up.read("fact_headcount"))
    number = mf.load(spark, f"{out_root}/_published").number
    s = silver(bronze, rules, **silver_options)
    tables = {f"dim_{e}": d for e, d in s.dims.items()} | {
        "fact_headcount": s.fact_headcount, "fact_payroll": s.fact_payroll,
        "fact_compensation": s.fact_compensation, "fact_workforce_movements": s.movements,
        "data_quality_log": resolved(s.quality_log)}
    entries = {}
    for name, df in tables.items():
        path = f"{out_root}/silver/{name}/v-{version}"
        part = ["period"] if name in ("fact_headcount", "fact_payroll") else []
        write_table(df, path, "overwrite", part)
        entries[name] = {"path": path}
    # Gold and the gate read the written silver tables, not the lineage.
    rd = {n: mf.read_entry(spark, e) for n, e in entries.items()}
    s2 = Silver({e: rd[f"dim_{e}"] for e in s.dims}, rd["fact_headcount"], rd["fact_payroll"],
                rd["fact_compensation"], rd["fact_workforce_movements"], rd["data_quality_log"])
    check(headcount_gate(s2.fact_headcount, "employee_id", "period", active=F.col("termination_date").isNull(), threshold_pct=threshold))
    res.review = dq.summary(rd["data_quality_log"]).first().asDict()
    return _finish(spark, out_root, version, entries, gold(s2, one_contract_per_employee), number, [], {"kind": "full"}, res, rd["fact_headcount"])


def restate_bronze(spark: SparkSession, bronze_path: str, corrections_landing: str, entity: str,
                   key: str | dict[str, str], start_period: str, end_period: str, triggered_by: str,
                   out_root: str) -> tuple[str, dict]:
    """R1 + R2 on a bronze table: the rows of ``key`` in [start, end] are
    withdrawn, and the corrected files landed under ``corrections_landing`` (same
    layout as the landing folder; newest file wins) take their place. Without a
    corrected row for a period the key is removed from it.

    ``key`` is an employee's id, or the values of one or more columns, e.g.
    ``{"department_id": "D1"}`` or ``{"employee_id": "E1", "contract_type": "TEMP"}``.

    Nothing is rewritten: the corrected rows and the scope are appended, and
    ``run_warehouse`` reads bronze with them applied, full or incremental. The
    audit row comes last. Returns (path of the corrected rows, audit row).
    """
    keys = {"employee_id": key} if isinstance(key, str) or key is None else dict(key)
    unknown = [c for c in keys if c not in ENTITY_FIELDS[entity]]
    if unknown:
        raise ValueError(f"Parameter validation failed: {entity} has no {', '.join(unknown)}")
    start_period, end_period = normalize_period(start_period), normalize_period(end_period)
    shown = keys["employee_id"] if list(keys) == ["employee_id"] else ",".join(f"{c}={v}" for c, v in sorted(keys.items()) if v)
    # validate parameters before any work
    audit_row(spark, shown, start_period, end_period, triggered_by)
    check_range(start_period, end_period)
    if not all(keys.values()):
        raise ValueError("Parameter validation failed: every key column needs a value")
    name, at = f"restate-{uuid.uuid4().hex}", time.time_ns() // 1000
    in_scope = F.col("_landed").between(start_period, end_period)
    for c, v in keys.items():
        in_scope = in_scope & (F.col(c) == v)
    removed = restated(spark, read_bronze(spark, bronze_path, entity), entity, out_root).where(in_scope).count()
    landed = read_landing(spark, corrections_landing, entity, run_id=name).withColumn("_landed", period_from_path("_source_file_name"))
    corrected = rows_of_newest(landed.where(in_scope), [*_row_keys(entity, keys), "_landed"], NEWEST)
    path = CORRECTIONS.format(out=out_root, entity=entity)
    write_table(corrected.withColumn("_at", F.lit(at)), path, "append")
    added = spark.read.parquet(path).where(F.col("_pipeline_run_id") == name).count()
    scope = spark.createDataFrame([(name, entity, json.dumps(dict(sorted(keys.items()))), start_period, end_period, at)], _SCOPE)
    write_table(scope, SCOPES.format(out=out_root), "append")
    audit = audit_row(spark, shown, start_period, end_period, triggered_by,
                      rows_removed=removed, rows_added=added)
    write_table(audit, f"{out_root}/silver/restatement_audit_log", "append")
    return path, audit.first().asDict()


def _row_keys(entity: str, keys: dict[str, str]) -> list[str]:
    """What the newest corrected file is judged by: the entity's key, with the
    columns of the scope. Payroll has no key of its own; its files are judged whole."""
    return sorted({*DIM_KEYS.get(entity, ["employee_id"]), *keys})
