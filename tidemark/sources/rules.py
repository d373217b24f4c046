"""Rule configuration (S16): thresholds plus, per entity, a list of
``{field, rule, severity}`` where ``rule`` is a SQL predicate a good row
satisfies. A rule may instead be ``{"field", "kind": "referential",
"ref": "<name>", "ref_key": "<column>", "severity"}``: the field must be
null or found among the referenced keys.

The file is configuration (tens of lines), so it is read once on the
driver; it is read through Spark so any file system the cluster uses works.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

SEVERITIES = ("CRITICAL", "ERROR", "WARNING")
DEFAULT_THRESHOLDS = {"headcount_variance_pct": 10}


@dataclass(frozen=True)
class Rule:
    field: str
    rule: str
    severity: str
    kind: str = "expr"
    ref: str | None = None
    ref_key: str | None = None

    @staticmethod
    def from_dict(d: dict) -> "Rule":
        kind = d.get("kind", "expr")
        text = d.get("rule") or (f"{d['field']} IN {d.get('ref')}.{d.get('ref_key')}"
                                 if kind == "referential" else "")
        return Rule(d["field"], text, d.get("severity", "ERROR").upper(), kind,
                    d.get("ref"), d.get("ref_key"))


@dataclass
class RuleSet:
    thresholds: dict = field(default_factory=dict)
    entities: dict = field(default_factory=dict)

    @staticmethod
    def from_dict(cfg: dict | None) -> "RuleSet":
        cfg = cfg or {}
        ents = {e: [Rule.from_dict(r) for r in (rules or [])]
                for e, rules in (cfg.get("entities") or {}).items()}
        return RuleSet(dict(cfg.get("thresholds") or {}), ents)

    @staticmethod
    def from_json(text: str) -> "RuleSet":
        return RuleSet.from_dict(json.loads(text) if text.strip() else {})

    @staticmethod
    def load(spark: SparkSession, path: str) -> "RuleSet":
        text = spark.read.text(path, wholetext=True).first()[0]
        return RuleSet.from_json(text)

    def entity_rules(self, entity: str) -> list[Rule]:
        return list(self.entities.get(entity, []))

    def by_severity(self, entity: str, severity: str) -> list[Rule]:
        return [r for r in self.entity_rules(entity) if r.severity == severity]

    def critical(self, entity: str) -> list[Rule]:
        return self.by_severity(entity, "CRITICAL")

    def errors(self, entity: str) -> list[Rule]:
        return self.by_severity(entity, "ERROR")

    def warnings(self, entity: str) -> list[Rule]:
        return self.by_severity(entity, "WARNING")

    def threshold(self, name: str, default=None):
        if default is None:
            default = DEFAULT_THRESHOLDS.get(name)
        return self.thresholds.get(name, default)

    def counts(self, entity: str) -> dict:
        return {s: len(self.by_severity(entity, s)) for s in SEVERITIES}
