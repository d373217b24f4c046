"""Banding columns (F5, F6) and exact rounding helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tenure bands, in days, and their labels.
TENURE_EDGES = (365, 1095, 1825)
TENURE_LABELS = ("0-1 year", "1-3 years", "3-5 years", "5+ years")

# Salary bands (upper bounds, exclusive) and their labels.
SALARY_EDGES = (50000, 80000, 120000)
SALARY_LABELS = ("Band 1", "Band 2", "Band 3", "Band 4")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(value, edges: Sequence, labels: Sequence[str]) -> Column:
    """``labels[i]`` for the first ``edges[i]`` with value < edge, else the last label.

    Null in, null out (no branch matches a null). The value is referenced
    once per edge only: Catalyst may inline it into pushed-down filters.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need exactly one more label than edges")
    v = _col(value)
    out = None
    for edge, label in zip(edges, labels):
        cond = v < F.lit(edge)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.when(v >= F.lit(edges[-1]), F.lit(labels[-1]))


def tenure_band(days) -> Column:
    return band(days, TENURE_EDGES, TENURE_LABELS)


def salary_band(amount, edges: Sequence = SALARY_EDGES,
                labels: Sequence[str] = SALARY_LABELS) -> Column:
    return band(amount, edges, labels)


def non_negative(value) -> Column:
    """Negative values become null (a data error, not a real value).

    Written with one reference to the value so inlining it stays cheap."""
    return F.nullif(F.greatest(_col(value), F.lit(-1)), F.lit(-1))


def pct_2dp(part, whole) -> Column:
    """``part / whole * 100`` rounded half-up to 2 decimals, exactly.

    Both inputs are counts; integer arithmetic avoids the binary-float ties
    that make ``round(x, 2)`` differ between engines.
    """
    p = _col(part).cast("long")
    w = _col(whole).cast("long")
    hundredths = F.floor((p * 20000 + w) / (w * 2))
    return F.when(w > 0, hundredths / F.lit(100.0))
