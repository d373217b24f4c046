"""DataFrame -> DataFrame operators.

``movements`` and ``restate`` are also submodule names, so those two
functions are imported from their modules: ``from
tidemark.operators.movements import movements``.
"""

from tidemark.operators.calendar import dim_date, dim_date_covering
from tidemark.operators.dedup import drop_null_keys, latest_per_key, latest_per_key_by_path
from tidemark.operators.facts import (
    compensation_fact,
    optional_column,
    payroll_fact,
    repair_before,
    valid_amounts,
    with_tenure,
)
from tidemark.operators.gate import HeadcountAnomaly, assert_no_anomaly, headcount_gate
from tidemark.operators.marts import (
    attrition_summary,
    compensation_bands,
    headcount_monthly,
    rolling_attrition,
    tenure_bands,
    workforce_movements,
)
from tidemark.operators.movements import hires, terminations, transfers
from tidemark.operators.periods import period_sequence
from tidemark.operators.quality import (
    empty_log,
    log_schema,
    quality_log,
    resolve,
    review,
    steward_review,
    summary,
    union_logs,
    unresolved,
)
from tidemark.operators.restate import audit_row
from tidemark.operators.scd2 import (
    apply_snapshot,
    as_of,
    current,
    empty_dimension,
    replay_snapshots,
)

__all__ = [
    "dim_date", "dim_date_covering", "drop_null_keys", "latest_per_key", "latest_per_key_by_path",
    "compensation_fact", "optional_column", "payroll_fact", "repair_before", "valid_amounts",
    "with_tenure", "HeadcountAnomaly", "assert_no_anomaly", "headcount_gate",
    "attrition_summary", "compensation_bands", "headcount_monthly", "rolling_attrition",
    "tenure_bands", "workforce_movements", "hires", "terminations", "transfers",
    "period_sequence", "empty_log", "log_schema", "quality_log", "resolve",
    "review", "steward_review", "summary", "union_logs", "unresolved", "audit_row",
    "apply_snapshot", "as_of", "current", "empty_dimension", "replay_snapshots",
]
