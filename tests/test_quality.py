"""Quality log: CRITICAL exclusivity, unknown = failure, referential, resolve, review."""

import datetime as dt


from tidemark.operators import quality as dq
from tidemark.sources.rules import Rule

RULES = [
    Rule("employee_id", "employee_id IS NOT NULL", "CRITICAL"),
    Rule("hire_date", "hire_date IS NOT NULL", "ERROR"),
    Rule("net_pay", "try_cast(net_pay AS BIGINT) >= 0", "ERROR"),
    Rule("gross_pay", "try_cast(gross_pay AS BIGINT) > 0", "WARNING"),
]


def frame(spark):
    return spark.createDataFrame([
        (None, None, "5", "0"),        # critical only
        ("E1", "2020-01-01", "abc", "10"),  # net not a number -> unknown -> failure
        ("E2", None, "-1", "0"),       # hire, net, gross
        ("E3", "2020-01-01", "7", "9"),  # clean
    ], "employee_id string, hire_date string, net_pay string, gross_pay string")


def test_log_entries(spark):
    log = dq.quality_log(frame(spark), "employees", RULES, key="employee_id")
    got = sorted((r["record_key"] or "-", r["field"], r["severity"]) for r in log.collect())
    assert got == [("-", "employee_id", "CRITICAL"), ("E1", "net_pay", "ERROR"),
                   ("E2", "gross_pay", "WARNING"), ("E2", "hire_date", "ERROR"),
                   ("E2", "net_pay", "ERROR")]
    def shape(schema):
        return [(f.name, f.dataType) for f in schema.fields]
    assert shape(log.schema) == shape(dq.log_schema())
    assert shape(dq.empty_log(spark).schema) == shape(dq.log_schema())
    e1 = log.where("record_key = 'E1'").first()
    assert e1["actual_value"] == "abc" and e1["requires_review"] and not e1["resolved"]


def test_referential_rule(spark):
    pay = spark.createDataFrame([("E1",), ("E9",), (None,)], "employee_id string")
    emp = spark.createDataFrame([("E1",), ("E1",), (None,)], "employee_id string")
    r = Rule("employee_id", "employee_id IN employees.employee_id", "ERROR", "referential",
             "employees", "employee_id")
    log = dq.quality_log(pay, "payroll_events", [r], key="employee_id", refs={"employees": emp})
    assert [x["record_key"] for x in log.collect()] == ["E9"]


def test_resolve_summary_review(spark):
    log = dq.quality_log(frame(spark), "employees", RULES, key="employee_id")
    res = spark.createDataFrame(
        [("employees", "net_pay", "E1", "ann", dt.datetime(2025, 1, 2), "ACCEPT"),
         ("employees", "net_pay", "E1", "bob", dt.datetime(2025, 1, 3), "CORRECT")],
        "entity string, field string, record_key string, resolved_by string, "
        "resolved_at timestamp, resolution_type string")
    out = dq.resolve(log, res, on=["entity", "field", "record_key"])
    e1 = out.where("record_key = 'E1'").first()
    assert e1["resolved"] and e1["resolved_by"] == "bob" and e1["resolution_type"] == "CORRECT"
    s = dq.summary(out).first()
    assert (s["total_issues"], s["critical"], s["errors"], s["warnings"]) == (4, 1, 2, 1)
    sev = [r["severity"] for r in dq.review(out).collect()]
    assert sev == ["CRITICAL", "ERROR", "ERROR", "WARNING"]
