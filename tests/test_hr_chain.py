"""The HR warehouse end to end on a small landing fixture."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.gate import HeadcountAnomaly
from tidemark.plans.hr import run_warehouse


def put(base, period, entity, rows, name="part-0.json"):
    d = f"{base}/{period}/{entity}"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/{name}", "w") as f:
        for r in rows:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


def landing(base):
    depts = [{"department_id": f"D{i}", "name": f"Dept {i}", "cost_centre": f"C{i}"} for i in (1, 2)]
    roles = [{"role_id": f"R{i}", "title": f"T{i}", "band": f"B{i}", "function": "F",
              "job_family": f"J{i}"} for i in (1, 2)]
    for p_i, period in enumerate(["2025-01", "2025-02", "2025-03"]):
        emps = []
        for i in range(1, 11):
            if period == "2025-03" and i == 10:
                continue  # E10 gone in March -> termination
            dept = "D2" if (i == 1 and p_i >= 1) else "D1"
            emps.append({"employee_id": f"E{i}", "full_name": f"N{i}", "hire_date": "2024-01-15",
                         "department_id": dept, "role_id": "R1"})
        if period == "2025-03":
            emps.append({"employee_id": "E12", "hire_date": "2025-02-20", "department_id": "D2",
                         "role_id": "R2"})
        if period == "2025-02":
            emps.append({"employee_id": None, "full_name": "ghost", "hire_date": "2024-01-01"})
            emps.append({"employee_id": "E11", "hire_date": "2025-06-01",
                         "termination_date": "2024-01-01", "department_id": "D1", "role_id": "R2"})
        put(base, period, "employees", emps)
        put(base, period, "departments", depts)
        put(base, period, "job_roles", roles)
        put(base, period, "contracts", [{"contract_id": f"K{i}", "employee_id": f"E{i}",
                                         "contract_type": "PERMANENT", "start_date": "2024-01-15"}
                                        for i in range(1, 11)])
        comp = [{"employee_id": f"E{i}", "salary": 40000 + i * 10000, "currency": "GBP",
                 "effective_date": "2024-01-15"} for i in range(1, 11)]
        if p_i == 2:
            for c in comp:
                c["compensation_category"] = "BASE"
        put(base, period, "compensation", comp)
        pay = [{"employee_id": f"E{i}", "period": period, "gross_pay": 3000, "deductions": 500,
                "net_pay": 2500} for i in range(1, 11)]
        pay.append({"employee_id": "E99", "period": period, "gross_pay": 0, "deductions": 0,
                    "net_pay": -5})
        pay.append({"employee_id": "E2", "period": period, "gross_pay": "n/a", "net_pay": "x"})
        put(base, period, "payroll_events", pay)


def test_run_warehouse(spark, tmp_path):
    base = str(tmp_path / "landing")
    landing(base)
    out = str(tmp_path / "wh")
    # March: 10 active (E10, E11 gone, E12 new) vs a mean of 10.5 -> passes
    res = run_warehouse(spark, base, out)
    t = {k: res.read(spark, k) for k in res.published.tables} | {k: spark.read.parquet(v) for k, v in res.tables.items() if k.startswith("bronze")}
    emp = t["dim_employees"]
    e1 = emp.where("employee_id = 'E1'").orderBy("__START_AT").collect()
    assert [(r["department_id"], r["__START_AT"], r["__END_AT"]) for r in e1] == \
        [("D1", "2025-01", "2025-02"), ("D2", "2025-02", None)]
    assert emp.where("employee_id = 'E10'").first()["__END_AT"] == "2025-03"
    mv = {(r["employee_id"], r["period"], r["event_type"])
          for r in t["fact_workforce_movements"].collect()}
    assert ("E1", "2025-02", "TRANSFER") in mv and ("E10", "2025-03", "TERMINATION") in mv
    assert ("E11", "2025-02", "HIRE") in mv and ("E11", "2025-03", "TERMINATION") in mv
    assert ("E12", "2025-03", "HIRE") in mv
    # E11's termination date was before its hire date: nulled in silver
    assert t["fact_headcount"].where("employee_id = 'E11'").first()["termination_date"] is None
    log = t["data_quality_log"]
    fields = sorted((r["entity"], r["field"]) for r in log.collect())
    assert ("employees", "employee_id") in fields       # null key, CRITICAL
    assert ("employees", "termination_date") in fields
    assert ("employees", "tenure_days") in fields       # E11 hired after the period
    assert fields.count(("payroll_events", "employee_id")) == 3   # E99 each period
    assert ("payroll_events", "net_pay") in fields and ("payroll_events", "gross_pay") in fields
    # payroll: E99 is unknown, E2's second row has no number -> kept rows are valid
    pay = t["fact_payroll"]
    assert pay.where("employee_id = 'E99'").count() == 0
    assert dict(pay.dtypes)["gross_pay"] == "decimal(18,2)"
    comp = t["fact_compensation"]
    assert comp.where("compensation_category = 'BASE'").count() == 10
    bands = t["compensation_bands"].collect()
    assert sum(r["employee_count"] for r in bands) == comp.count()
    assert max(r["max_salary"] for r in bands) == 140000      # numeric, not text order
    hm = t["headcount_monthly"].where("period = '2025-03'")
    assert hm.agg(F.sum("employee_count")).first()[0] == 10
    assert res.gate["headcount"] == 10
    tb = t["tenure_bands"].groupBy("period", "department_id").agg(F.sum("pct_of_department").alias("s"))
    assert all(abs(r["s"] - 100) < 0.05 for r in tb.collect())
    assert res.review["total_issues"] == log.count()
    # a second run over the same landing adds nothing to bronze
    res2 = run_warehouse(spark, base, out)
    assert spark.read.parquet(res2.tables["bronze_employees"]).count() == \
        t["bronze_employees"].count()


def test_gate_stops_the_chain(spark, tmp_path):
    base = str(tmp_path / "landing")
    landing(base)
    # April: only 3 employees -> far below the mean
    put(base, "2025-04", "employees", [{"employee_id": f"E{i}", "hire_date": "2024-01-15",
                                        "department_id": "D1", "role_id": "R1"} for i in (1, 2, 3)])
    for ent in ("departments", "job_roles", "contracts", "compensation", "payroll_events"):
        put(base, "2025-04", ent, [])
    with pytest.raises(HeadcountAnomaly):
        run_warehouse(spark, base, str(tmp_path / "wh"))


def test_chain_options(spark, tmp_path):
    """Contract dedup (X6), end at termination date (X7), rehire."""
    base = str(tmp_path / "landing")
    landing(base)
    # E3 gets a second open contract from February; E4 is terminated in
    # January but stays listed (as the source system does)
    for p in ("2025-02", "2025-03"):
        put(base, p, "contracts", [{"contract_id": "K3b", "employee_id": "E3",
                                    "contract_type": "TEMP", "start_date": "2025-02-01"}],
            name="part-1.json")
    put(base, "2025-02", "employees", [{"employee_id": "E4", "hire_date": "2024-01-15",
                                        "termination_date": "2025-01-20",
                                        "department_id": "D1", "role_id": "R1"}], name="part-1.json")
    out = str(tmp_path / "wh")
    plain = run_warehouse(spark, base, out, gate=False)
    hm = plain.read(spark, "headcount_monthly")
    feb = hm.where("period = '2025-02'").agg(F.sum("employee_count")).first()[0]
    deduped = run_warehouse(spark, base, str(tmp_path / "wh2"), gate=False,
                            one_contract_per_employee=True, end_at_termination=True)
    hm2 = deduped.read(spark, "headcount_monthly")
    feb2 = hm2.where("period = '2025-02'").agg(F.sum("employee_count")).first()[0]
    assert feb2 == feb - 1          # E3 counted once
    mv = deduped.read(spark, "fact_workforce_movements")
    assert mv.where("employee_id = 'E4' AND event_type = 'TERMINATION'").count() == 1
    # dim_date is appended once: a second run adds nothing
    d1 = deduped.read(spark, "dim_date").count()
    again = run_warehouse(spark, base, str(tmp_path / "wh2"), gate=False)
    assert again.read(spark, "dim_date").count() == d1 == 4748


def e_rows(spark, res, employee):
    return [(r["department_id"], r["__START_AT"], r["__END_AT"]) for r in res.read(
        spark, "dim_employees").where(f"employee_id = '{employee}'").orderBy("__START_AT").collect()]


@pytest.mark.parametrize("incremental", [False, True])
def test_restatement(spark, tmp_path, incremental):
    """R1/R2 end to end: corrected files for one employee and period range take
    the place of their rows, and the next run shows it in every table."""
    from tidemark.plans.hr import restate_bronze
    base = str(tmp_path / "landing")
    landing(base)
    out = str(tmp_path / "wh")
    res = run_warehouse(spark, base, out, gate=False, incremental=incremental)
    fixes = str(tmp_path / "restatements")
    put(fixes, "2025-02", "employees", [{"employee_id": "E5", "hire_date": "2024-01-15",
                                         "department_id": "D2", "role_id": "R2"}], name="fix-1.json")
    put(fixes, "2025-01", "employees", [{"employee_id": "E6", "hire_date": "2024-01-15",
                                         "department_id": "D2", "role_id": "R2"}], name="fix-2.json")
    args = (spark, res.tables["bronze_employees"], fixes, "employees")
    path, audit = restate_bronze(*args, "E5", "2025-2", "2025-02", "steward", out)
    assert audit["rows_added"] == 1 and audit["rows_removed"] == 1
    assert (audit["start_period"], audit["end_period"]) == ("2025-02", "2025-02")
    again = run_warehouse(spark, base, out, gate=False, incremental=incremental)
    assert e_rows(spark, again, "E5") == [("D1", "2025-01", "2025-02"), ("D2", "2025-02", "2025-03"),
                                          ("D1", "2025-03", None)]
    head = again.read(spark, "fact_headcount")
    assert head.where("employee_id = 'E5' AND period = '2025-02'").first()["department_id"] == "D2"
    assert head.where("employee_id = 'E6' AND period = '2025-01'").first()["department_id"] == "D1"
    # a second restatement, without corrected rows, removes the employee
    _, audit = restate_bronze(*args, "E7", "2025-01", "2025-03", "steward", out)
    assert (audit["rows_added"], audit["rows_removed"]) == (0, 3)
    gone = run_warehouse(spark, base, out, gate=False, incremental=incremental)
    assert e_rows(spark, gone, "E7") == [] and len(e_rows(spark, gone, "E5")) == 3
    assert gone.read(spark, "fact_payroll").where("employee_id = 'E7'").count() == 0
    log = spark.read.parquet(f"{out}/silver/restatement_audit_log")
    assert log.count() == 2
    for bad in (("", "2025-01", "2025-02"), ("E5", "2025-03", "2025-02")):
        with pytest.raises(ValueError):
            restate_bronze(*args, *bad, "x", out)
    assert log.count() == 2


COMPARED = ("headcount_monthly", "fact_workforce_movements", "workforce_movements", "attrition_summary",
            "fact_headcount", "fact_payroll", "fact_compensation", "compensation_bands", "tenure_bands", "data_quality_log")


def assert_same_tables(spark, inc, rep):
    order = lambda t: tuple("" if x is None else str(x) for x in t)
    for t in COMPARED + tuple(f"dim_{e}" for e in ("employees", "departments", "job_roles", "contracts")):
        a, b = inc.read(spark, t), rep.read(spark, t)
        cols = [c for c in sorted(a.columns) if c not in ("_ingested_at", "_source_file_name")]
        assert cols == [c for c in sorted(b.columns) if c not in ("_ingested_at", "_source_file_name")]
        assert sorted(map(tuple, a.select(cols).collect()), key=order) == \
            sorted(map(tuple, b.select(cols).collect()), key=order), t


def test_incremental_equals_full_for_late_split_and_corrected_files(spark, tmp_path):
    """Files in a random order over several runs: late periods, periods in parts,
    corrections, employees that become known after their payroll."""
    import random
    import shutil
    base, now = str(tmp_path / "all"), 1_700_000_000
    landing(base)
    put(base, "2025-01", "employees", [{"employee_id": "E1", "hire_date": "2024-01-15", "department_id": "D2",
                                        "role_id": "R2"}], name="fix.json")
    put(base, "2025-01", "payroll_events", [
        {"employee_id": "E1", "period": "2025-01", "gross_pay": "9999.25", "net_pay": "5000"},
        {"employee_id": "E1", "period": "2025-01", "gross_pay": "100", "net_pay": "50.5"}], name="fix.json")
    put(base, "2025-02", "employees", [{"employee_id": "E99", "hire_date": "2025-02-01", "department_id": "D1",
                                        "role_id": "R1"}], name="more.json")
    put(base, "2025-03", "compensation", [{"employee_id": "E2", "salary": "n/a"}], name="bad.json")
    files = sorted(str(p.relative_to(base)) for p in tmp_path.joinpath("all").rglob("*.json"))
    for i, f in enumerate(sorted(files, key=lambda f: ("part-0" not in f, f))):
        os.utime(f"{base}/{f}", (now + i, now + i))
    full = run_warehouse(spark, base, str(tmp_path / "wh_full"), gate=False)
    pay = full.read(spark, "fact_payroll").where("employee_id = 'E1' AND period = '2025-01'")
    assert sorted(float(r["gross_pay"]) for r in pay.collect()) == [100.0, 9999.25]
    assert full.read(spark, "fact_payroll").where("employee_id = 'E2'").count() == 3
    rng = random.Random(4)
    first = [f for f in files if "2025-02" in f and "part-0" in f]
    rest = [f for f in files if f not in first]
    rng.shuffle(rest)
    parts = [first, rest[:9], rest[9:]]
    for part in parts:
        for f in part:
            os.makedirs(os.path.dirname(f"{tmp_path}/some/{f}"), exist_ok=True)
            shutil.copy2(f"{base}/{f}", f"{tmp_path}/some/{f}")
        for ent in ("employees", "departments", "job_roles", "contracts", "compensation", "payroll_events"):
            put(str(tmp_path / "some"), "2024-12", ent, [], name="none.json")
        inc = run_warehouse(spark, str(tmp_path / "some"), str(tmp_path / "wh"), gate=False, incremental=True)
    assert_same_tables(spark, inc, full)


def test_period_stopped_by_the_gate_can_be_repaired(spark, tmp_path):
    """A short March trips the gate and commits nothing; its second part lands,
    and the incremental run equals the full one."""
    base, out = str(tmp_path / "landing"), str(tmp_path / "wh")
    landing(base)
    with open(f"{base}/2025-03/employees/part-0.json") as f:
        lines = f.read().splitlines()
    for p in ("2025-03",):
        put(base, p, "employees", lines[:3])
    with pytest.raises(HeadcountAnomaly):
        run_warehouse(spark, base, out, incremental=True)
    assert not os.path.exists(f"{out}/_published")
    put(base, "2025-03", "employees", lines[3:], name="part-1.json")
    inc = run_warehouse(spark, base, out, incremental=True)
    assert inc.gate["headcount"] == 10
    assert_same_tables(spark, inc, run_warehouse(spark, base, str(tmp_path / "wh_full")))


def test_rules_of_every_entity(spark, tmp_path):
    """Rules on any entity are checked, references by name, a re-sent file once."""
    from tidemark.sources.rules import RuleSet
    base = str(tmp_path / "landing")
    landing(base)
    for name in ("a.json", "b.json"):       # the same file, sent twice
        put(base, "2025-01", "departments", [{"department_id": "D9", "cost_centre": "C9"}], name=name)
    rules = RuleSet.from_dict({"entities": {
        "departments": [{"field": "name", "rule": "name IS NOT NULL", "severity": "ERROR"}],
        "contracts": [{"field": "employee_id", "kind": "referential", "ref": "payroll_events",
                       "ref_key": "employee_id", "severity": "WARNING"}]}})
    put(base, "2025-02", "contracts", [{"contract_id": "KX", "employee_id": "EX", "contract_type": "TEMP",
                                        "start_date": "2025-01-01"}], name="x.json")
    res = run_warehouse(spark, base, str(tmp_path / "wh"), rules=rules, gate=False)
    log = res.read(spark, "data_quality_log")
    assert sorted((r["entity"], r["field"], r["employee_id"]) for r in log.collect()) == [
        ("contracts", "employee_id", "EX"), ("departments", "name", "D9")]


def test_incremental_chain_equals_replay(spark, tmp_path):
    """Periods landing one run at a time, dimensions folded incrementally,
    end equal to the replay of everything."""
    import shutil
    full = str(tmp_path / "full")
    landing(full)
    base = str(tmp_path / "landing")
    out = str(tmp_path / "wh")
    for period in ("2025-01", "2025-02", "2025-03"):
        shutil.copytree(f"{full}/{period}", f"{base}/{period}")
        inc = run_warehouse(spark, base, out, gate=False, incremental=True)
    rep = run_warehouse(spark, full, str(tmp_path / "wh_replay"), gate=False)
    order = lambda t: tuple("" if x is None else str(x) for x in t)
    for ent in ("employees", "departments", "job_roles", "contracts"):
        a = inc.read(spark, f"dim_{ent}")
        b = rep.read(spark, f"dim_{ent}").select(*a.columns)
        assert sorted(map(tuple, a.collect()), key=order) == sorted(map(tuple, b.collect()), key=order)
    assert inc.published.number == 3
    for t in ("headcount_monthly", "fact_workforce_movements", "workforce_movements",
              "attrition_summary", "fact_headcount", "fact_payroll", "fact_compensation"):
        a = inc.read(spark, t)
        b = rep.read(spark, t).select(*a.columns)
        if t.startswith("fact_") and t != "fact_workforce_movements":
            a = a.drop("_ingested_at", "_source_file_name")
            b = b.drop("_ingested_at", "_source_file_name")
        assert sorted(map(tuple, a.collect()), key=order) == sorted(map(tuple, b.collect()), key=order), t


def test_command_line(spark, tmp_path, capsys):
    from tidemark.__main__ import main
    base = str(tmp_path / "landing")
    landing(base)
    out = str(tmp_path / "wh")
    assert main(["run", "--landing", base, "--out", out, "--no-gate"]) == 0
    res = json.loads(capsys.readouterr().out)
    assert res["review"]["total_issues"] > 0
    assert main(["review", "--log", res["tables"]["data_quality_log"], "--show", "5"]) == 0
    assert '"critical"' in capsys.readouterr().out


def test_resolutions_persist_across_runs(spark, tmp_path):
    from tidemark.plans.hr import RESOLUTION_KEYS, record_resolutions
    base = str(tmp_path / "landing")
    landing(base)
    out = str(tmp_path / "wh")
    first = run_warehouse(spark, base, out, gate=False)
    log = first.read(spark, "data_quality_log")
    picked = log.where("entity = 'payroll_events' AND field = 'employee_id'")
    n = picked.count()
    assert n == 3
    record_resolutions(spark, out, picked.select(
        *RESOLUTION_KEYS,
        F.lit("steward").alias("resolved_by"), F.current_timestamp().alias("resolved_at"),
        F.lit("ACCEPT").alias("resolution_type")))
    second = run_warehouse(spark, base, out, gate=False)
    log2 = second.read(spark, "data_quality_log")
    assert log2.where("resolved").count() == n
    assert second.review["total_issues"] == first.review["total_issues"] - n
