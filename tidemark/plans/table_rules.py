"""The rule set used on the driver's test tables (same format as a rules file)."""

# Rules for the test tables, in the rules-file format.
TABLE_RULES = {
    "thresholds": {"headcount_variance_pct": 2},
    "entities": {
        "customer": [
            {"field": "c_custkey", "rule": "c_custkey IS NOT NULL", "severity": "CRITICAL"},
            {"field": "c_acctbal", "rule": "c_acctbal >= 0", "severity": "ERROR"},
            {"field": "c_name", "rule": "c_name IS NOT NULL", "severity": "ERROR"},
            {"field": "c_mktsegment",
             "rule": "c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')",
             "severity": "WARNING"},
        ],
        "orders": [
            {"field": "o_orderkey", "rule": "o_orderkey IS NOT NULL", "severity": "CRITICAL"},
            {"field": "o_custkey", "kind": "referential", "ref": "solvent_customers",
             "ref_key": "c_custkey", "severity": "ERROR"},
            {"field": "o_totalprice", "rule": "o_totalprice > 0", "severity": "ERROR"},
            {"field": "o_orderpriority", "rule": "o_orderpriority <> '5-LOW'", "severity": "WARNING"},
        ],
    },
}
