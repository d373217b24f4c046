"""What a run publishes: whole or not at all, from what is new, equal to a full run."""

import glob
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from tests.test_hr_chain import assert_same_tables, landing, put
from tidemark.plans import hr, maintained
from tidemark.plans.hr import restate_bronze, run_warehouse
from tidemark.sources import manifest as mf

PERIODS = ("2025-01", "2025-02", "2025-03")


def land(full, base, period):
    shutil.copytree(f"{full}/{period}", f"{base}/{period}", dirs_exist_ok=True)


def test_a_new_period_opens_no_older_files(spark, tmp_path):
    """The bronze files of January are made unreadable before March lands."""
    full, base, out = (str(tmp_path / n) for n in ("full", "landing", "wh"))
    landing(full)
    for p in PERIODS[:2]:
        land(full, base, p)
        run_warehouse(spark, base, out, gate=False, incremental=True)
    broken = glob.glob(f"{out}/bronze/*/_landed=2025-01/**/*.parquet", recursive=True)
    assert len(broken) >= 6
    for f in broken:
        with open(f, "wb") as file:
            file.write(b"not parquet")
        os.remove(f"{os.path.dirname(f)}/.{os.path.basename(f)}.crc")
    land(full, base, "2025-03")
    inc = run_warehouse(spark, base, out, gate=False, incremental=True)
    assert_same_tables(spark, inc, run_warehouse(spark, full, str(tmp_path / "wh_full"), gate=False))
    # and only March's partitions are written anew
    versions = {p: v for p, v in inc.published.tables["fact_headcount"]["parts"].items()}
    assert len({versions[f"period={p}"] for p in PERIODS}) == 3


def test_a_crash_at_any_step_leaves_the_former_tables(spark, tmp_path, monkeypatch):
    """A run is stopped before each of its writes in turn; readers see the former
    run, and the next run equals a full one."""
    full, base, out = (str(tmp_path / n) for n in ("full", "landing", "wh"))
    landing(full)
    for p in PERIODS[:2]:
        land(full, base, p)
    former = run_warehouse(spark, base, out, gate=False, incremental=True)
    seen = sorted(map(str, former.read(spark, "headcount_monthly").collect()))
    land(full, base, "2025-03")
    steps = [(mf, "record_files", 3), (hr, "update_dimension", 2), (mf, "replace_parts", 1), (mf, "replace_parts", 9), (hr, "write_table", 4),
             (mf, "publish", 1)]
    for module, name, nth in steps:
        plain, calls = getattr(module, name), []

        def failing(*args, plain=plain, calls=calls, nth=nth, **options):
            calls.append(1)
            if len(calls) == nth:
                raise OSError("stopped")
            return plain(*args, **options)

        monkeypatch.setattr(module, name, failing)
        with pytest.raises(OSError, match="stopped"):
            run_warehouse(spark, base, out, gate=False, incremental=True)
        monkeypatch.setattr(module, name, plain)
        now = mf.load(spark, f"{out}/_published")
        assert now.number == former.published.number
        assert sorted(map(str, mf.read_entry(spark, now.tables["headcount_monthly"]).collect())) == seen
    inc = run_warehouse(spark, base, out, gate=False, incremental=True)
    assert_same_tables(spark, inc, run_warehouse(spark, full, str(tmp_path / "wh_full"), gate=False))
    # folders of the runs that stopped are named by no manifest
    dead = mf.vacuum(spark, f"{out}/_published", keep=1)
    assert dead and not any(os.path.exists(d) for d in dead)
    assert inc.read(spark, "fact_headcount").count() == 31 and inc.read(spark, "data_quality_log").count() > 0


def test_two_runs_cannot_publish_the_same_number(spark, tmp_path):
    root = str(tmp_path / "m")
    first = mf.publish(spark, root, mf.Manifest(tables={"t": {"path": "x"}}))
    assert (first.number, mf.load(spark, root).tables) == (1, {"t": {"path": "x"}})
    with pytest.raises(RuntimeError, match="another run"):
        mf.publish(spark, root, mf.Manifest())
    assert mf.load(spark, root).tables == {"t": {"path": "x"}}


def test_parts_are_replaced_by_name(spark, tmp_path):
    """Odd values, null and values that look like numbers; a part without rows goes."""
    root = str(tmp_path / "t")
    rows = [("0125", 1), ("a/b=c", 2), (None, 3), ("0225", 4)]
    entry = mf.replace_parts(spark.createDataFrame(rows, "period string, v long"), None, root, "one", ["period"], None)
    read = lambda e: {(r.period, r.v) for r in mf.read_entry(spark, e).collect()}
    assert read(entry) == set(rows)
    entry = mf.replace_parts(spark.createDataFrame([(None, 5), ("a/b=c", 6)], "period string, v long"), entry, root, "two", ["period"],
                             [(None,), ("a/b=c",), ("0225",)])
    assert read(entry) == {("0125", 1), (None, 5), ("a/b=c", 6)}
    assert {(r.period, r.v) for r in mf.read_parts(spark, entry, [(None,), ("0225",)]).collect()} == {(None, 5)}
    assert read(entry | {"parts": {}}) == set()


@pytest.mark.parametrize("seed", [7, 8])
def test_runs_in_any_order_with_restatements(spark, tmp_path, seed):
    """Files in a random order; payroll periods that look like numbers, empty or
    missing; an extreme salary withdrawn; a department, a contract, an employee and
    payroll restated between runs."""
    rng, base, out = random.Random(seed), str(tmp_path / "all"), str(tmp_path / "wh")
    landing(base)
    put(base, "2025-02", "payroll_events", [
        {"employee_id": f"E{i}", "period": p, "gross_pay": "10.5", "net_pay": "5"}
        for i, p in ((1, "0125"), (2, "0225"), (3, None), (4, ""), (99, "0125"), (3, "2025-01"))], name="odd.json")
    put(base, "2025-03", "employees", [{"employee_id": "E99", "hire_date": "2025-02-01", "department_id": "D2", "role_id": "R1"}], name="more.json")
    put(base, "2025-01", "compensation", [{"employee_id": "E3", "salary": 999999, "currency": "GBP"}], name="much.json")
    files = sorted(str(p.relative_to(base)) for p in tmp_path.joinpath("all").rglob("*.json"))
    for i, f in enumerate(sorted(files, key=lambda f: ("part-0" not in f, f))):
        os.utime(f"{base}/{f}", (1_700_000_000 + i, 1_700_000_000 + i))
    rng.shuffle(files)
    some, fixes = str(tmp_path / "some"), str(tmp_path / "fixes")
    for ent in hr.ENTITY_FIELDS:
        put(fixes, "2024-12", ent, [], name="none.json")
    put(fixes, "2025-02", "departments", [{"department_id": "D1", "name": "Renamed", "cost_centre": "C1"}])
    put(fixes, "2025-01", "contracts", [{"contract_id": "K2", "employee_id": "E2", "contract_type": "TEMP", "start_date": "2024-01-15"}])
    put(fixes, "2025-01", "compensation", [{"employee_id": "E3", "salary": 5, "currency": "GBP"}])
    restatements = [("departments", {"department_id": "D1"}, "2025-01", "2025-02"),
                    ("contracts", {"employee_id": "E2", "contract_type": "PERMANENT"}, "2025-01", "2025-01"),
                    ("employees", "E7", "2025-01", "2025-03"), ("compensation", "E3", "2025-01", "2025-01"),
                    ("payroll_events", "E3", "2025-02", "2025-02")]
    rng.shuffle(restatements)
    third = -(-len(files) // 3)
    for i in range(3):
        for f in files[i * third:(i + 1) * third]:
            os.makedirs(os.path.dirname(f"{some}/{f}"), exist_ok=True)
            shutil.copy2(f"{base}/{f}", f"{some}/{f}")
        for ent in hr.ENTITY_FIELDS:
            put(some, "2024-12", ent, [], name="none.json")
        inc = run_warehouse(spark, some, out, gate=False, incremental=True)
        for entity, key, start, end in restatements[2 * i:2 * i + 2]:
            _, audit = restate_bronze(spark, inc.tables[f"bronze_{entity}"], fixes, entity, key, start, end, "steward", out)
            assert audit["status"] == "SUCCESS"
    inc = run_warehouse(spark, some, out, gate=False, incremental=True)
    full = run_warehouse(spark, some, out, gate=False)
    assert_same_tables(spark, inc, full)
    shown = {r["period"] for r in inc.read(spark, "fact_payroll").select("period").distinct().collect()}
    assert {"0125", "0225", None} < shown and "" not in shown
    log = spark.read.parquet(f"{out}/silver/restatement_audit_log")
    assert {r["employee_id"] for r in log.collect()} == {"department_id=D1", "contract_type=PERMANENT,employee_id=E2", "E7", "E3"}


def test_restatement_of_an_unknown_column_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="has no colour"):
        restate_bronze(spark, "none", "none", "departments", {"colour": "red"}, "2025-01", "2025-01", "me", str(tmp_path))
    with pytest.raises(ValueError, match="required|needs a value"):
        restate_bronze(spark, "none", "none", "departments", {"department_id": ""}, "2025-01", "2025-01", "me", str(tmp_path))


def test_states_give_the_marts(spark):
    """Gold from states equals the marts over all rows, nulls and doubles included."""
    from tidemark.operators import marts
    head = spark.createDataFrame(
        [("E1", "2025-01", "D1", "R1", "0-1 year", None), ("E2", "2025-01", "D1", None, "0-1 year", None), ("E3", "2025-01", None, "R9", None, None),
         ("E1", "2025-02", "D2", "R1", "0-1 year", None), ("E4", "2025-02", "D2", "R1", "3-5 years", "2025-01-31"), (None, "2025-02", "D1", "R1", "5+ years", None)],
        "employee_id string, period string, department_id string, role_id string, tenure_band string, termination_date string")
    contracts = spark.createDataFrame([("E1", "PERMANENT"), ("E1", "TEMP"), ("E3", None)], "employee_id string, contract_type string")
    none = F.lit(None).cast("string")
    dims = {"departments": spark.createDataFrame([("D1", "One"), ("D2", "Two")], "department_id string, name string"),
            "job_roles": spark.createDataFrame([("R1", "B1", "J1")], "role_id string, band string, job_family string"),
            "employees": head.where("employee_id is not null and period = '2025-02' or employee_id in ('E2', 'E3')").select(
                "employee_id", "role_id", "department_id")}
    dims = {n: d.withColumn("__END_AT", none) for n, d in dims.items()}
    comp = spark.createDataFrame([("E1", "2025-01", "10.10"), ("E1", "2025-02", "10.15"), ("E2", "2025-01", None), ("E3", "2025-01", "7"), ("E9", "2025-01", "3")],
                                 "employee_id string, period string, salary string").withColumn("salary", F.col("salary").cast("decimal(18,2)"))
    moves = spark.createDataFrame([("E1", "2025-02", "TRANSFER", "D1", "D2"), ("E2", "2025-02", "TERMINATION", "D1", None), ("E8", "2025-02", "TERMINATION", None, None)],
                                  "employee_id string, period string, event_type string, from_department_id string, department_id string")
    got = maintained.gold_of_states(maintained.headcount_states(head, contracts),
                                    maintained.salary_states(comp, dims["employees"].drop("__END_AT")), maintained.movement_states(moves), dims)
    dept = dims["departments"].select("department_id", F.col("name").alias("department_name"))
    roles = dims["job_roles"].drop("__END_AT")
    want = {
        "headcount_monthly": marts.headcount_monthly(head, [(dept, "department_id"), (contracts, "employee_id"), (roles.select("role_id", "band"), "role_id")]),
        "attrition_summary": marts.attrition_summary(moves, dept),
        "compensation_bands": marts.compensation_bands(comp, [(dims["employees"].drop("__END_AT"), "employee_id"), (roles, "role_id"), (dept, "department_id")]),
        "workforce_movements": marts.workforce_movements(moves, dept.withColumnRenamed("department_name", "name")),
        "tenure_bands": marts.tenure_bands(head, [(dept, "department_id"), (contracts, "employee_id")]),
    }
    for name, df in want.items():
        assert dict(got[name].dtypes) == dict(df.dtypes), name
        assert sorted(map(str, got[name].select(df.columns).collect())) == sorted(map(str, df.collect())), name
