"""Rule file loading: the reference's loader cases, restated."""

import json

from tidemark.plans.hr import RULES_PATH
from tidemark.sources.rules import RuleSet


def test_counts_per_severity_for_employees():
    rs = RuleSet.from_json(open(RULES_PATH).read())
    assert rs.counts("employees") == {"CRITICAL": 1, "ERROR": 3, "WARNING": 0}
    assert [r.field for r in rs.critical("employees")] == ["employee_id"]
    assert [r.field for r in rs.warnings("payroll_events")] == ["gross_pay"]
    assert rs.threshold("headcount_variance_pct") == 10


def test_unknown_entity_and_malformed_config():
    assert RuleSet.from_dict({}).entity_rules("employees") == []
    assert RuleSet.from_dict({"thresholds": {}}).entity_rules("x") == []
    assert RuleSet.from_json("{}").threshold("headcount_variance_pct") == 10
    assert RuleSet.from_json(json.dumps({"entities": {"e": []}})).counts("e") == \
        {"CRITICAL": 0, "ERROR": 0, "WARNING": 0}


def test_load_through_spark(spark):
    rs = RuleSet.load(spark, RULES_PATH)
    assert len(rs.entity_rules("payroll_events")) == 4
    assert rs.entity_rules("payroll_events")[0].kind == "referential"
