"""Landing ingest (rescue, period from path, re-run), dedup and restatement."""

import json
import os


from tidemark.functions.periods import period_from_path
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.restate import audit_row, restate
from tidemark.sources.landing import read_landing
from tidemark.streaming.ingest import ingest_to_bronze


def write_lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for r in rows:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


def test_stream_ingest_rescue_and_rerun(spark, tmp_path):
    base = str(tmp_path / "landing")
    write_lines(f"{base}/2025-01/departments/a.json",
                [{"department_id": "D1", "name": "Ops", "cost_centre": "C1", "extra": 5},
                 {"department_id": "D2", "name": "HR", "cost_centre": 7},
                 "not json"])
    fields = ["department_id", "name", "cost_centre", "parent_department_id"]
    out, ck = str(tmp_path / "bronze"), str(tmp_path / "ck")
    ingest_to_bronze(spark, base, "departments", out, ck, fields, run_id="r1")
    b = spark.read.parquet(out)
    assert b.count() == 3
    d1 = b.where("department_id = 'D1'").first()
    assert json.loads(d1["_rescued_data"]) == {"extra": "5"} and d1["_pipeline_run_id"] == "r1"
    assert b.where("department_id = 'D2'").first()["cost_centre"] == "7"
    assert b.where("department_id IS NULL").first()["_rescued_data"] == "not json"
    assert b.select(period_from_path("_source_file_name")).distinct().first()[0] == "2025-01"
    # re-running adds nothing; a new file adds its rows only
    ingest_to_bronze(spark, base, "departments", out, ck, fields, run_id="r2")
    assert spark.read.parquet(out).count() == 3
    write_lines(f"{base}/2025-02/departments/b.json", [{"department_id": "D1", "name": "Ops2"}])
    ingest_to_bronze(spark, base, "departments", out, ck, fields, run_id="r3")
    assert spark.read.parquet(out).count() == 4
    batch = read_landing(spark, base, "departments", fields)
    assert batch.count() == 4


def test_period_from_unmatched_path_is_null(spark):
    df = spark.createDataFrame([("/x/2025-01/e/a.json",), ("/x/e/period=2025-01-03/a.json",),
                                ("/x/e/a.json",)], "p string")
    got = [r[0] for r in df.select(period_from_path("p")).collect()]
    assert got == ["2025-01", "2025-01-03", None]


def test_latest_per_key_resent_file_and_ties(spark):
    df = spark.createDataFrame([("E1", "2025-01", 1, "a"), ("E1", "2025-01", 2, "b"),
                                ("E1", "2025-02", 1, "c"), ("E2", "2025-01", None, "d"),
                                ("E2", "2025-01", 1, "e"), (None, "2025-01", 9, "z")],
                               "k string, p string, t int, v string")
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], ["p", "t"]).collect())
    assert got == [("E1", "2025-02", 1, "c"), ("E2", "2025-01", 1, "e")]
    per = latest_per_key(df, ["k", "p"], ["t"])
    assert per.count() == 3


def test_restate_replaces_scope_only(spark):
    base = spark.createDataFrame([("E1", "2025-01", 10), ("E1", "2025-02", 20), ("E1", "2025-03", 30),
                                  ("E2", "2025-02", 40)], "k string, period string, v int")
    corr = spark.createDataFrame([("E1", "2025-02", 21), ("E1", "2025-09", 99)],
                                 "k string, period string, v int")
    got = sorted(tuple(r) for r in restate(base, corr, ["k"], "period", "2025-02", "2025-03").collect())
    assert got == [("E1", "2025-01", 10), ("E1", "2025-02", 21), ("E2", "2025-02", 40)]


def test_audit_row_requires_parameters(spark):
    import pytest
    with pytest.raises(ValueError, match="triggered_by is required"):
        audit_row(spark, "E1", "2025-01", "2025-02", "")
    r = audit_row(spark, "E1", "2025-01", "2025-02", "me", rows_removed=2, rows_added=1).first()
    assert r["status"] == "SUCCESS" and r["rows_added"] == 1


def test_foreach_batch_drives_a_fold(spark, tmp_path):
    """A stream drives a batch function once per micro-batch."""
    from tidemark.streaming.ingest import ingest_each_batch, landing_stream
    base = str(tmp_path / "landing")
    write_lines(f"{base}/2025-01/departments/a.json", [{"department_id": "D1", "name": "A"}])
    write_lines(f"{base}/2025-02/departments/a.json", [{"department_id": "D1", "name": "B"}])
    seen = []
    stream = landing_stream(spark, base, "departments", max_files_per_trigger=1)
    ingest_each_batch(stream, lambda df, i: seen.append(sorted(r["name"] for r in df.collect())),
                      str(tmp_path / "ck"))
    assert sorted(x for b in seen for x in b) == ["A", "B"] and len(seen) == 2


def test_normalize_period():
    from tidemark.functions.periods import normalize_period
    assert normalize_period("2025-1") == "2025-01"
    assert normalize_period(" 2025-01-5") == "2025-01-05"
    assert normalize_period("bad") == "bad"


def test_latest_per_key_by_path(spark):
    import datetime as dt

    from tidemark.operators.dedup import latest_per_key_by_path
    t1, t2 = dt.datetime(2025, 3, 1), dt.datetime(2025, 3, 2)
    df = spark.createDataFrame([
        ("E1", "D1", "/l/2025-01/employees/a.json", t2),
        ("E1", "D2", "/l/2025-02/employees/a.json", t1),   # newer period wins over newer ingest
        ("E2", "D3", "/l/2025-02/employees/a.json", t1),
        ("E2", "D4", "/l/2025-02/employees/b.json", t2),   # same period: newer ingest wins
    ], "employee_id string, department_id string, _source_file_name string, _ingested_at timestamp")
    got = {r["employee_id"]: r["department_id"]
           for r in latest_per_key_by_path(df, ["employee_id"]).collect()}
    assert got == {"E1": "D2", "E2": "D4"}
