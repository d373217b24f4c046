"""Fact tables built from snapshot rows.

Amounts arrive as text in bronze, so every numeric check goes through
``try_cast``: malformed text becomes null (and fails the not-null check)
instead of stopping the job under ANSI, and numbers compare as numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.bands import non_negative, salary_band, tenure_band
from tidemark.functions.periods import parse_date, period_start


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(c) -> Column:
    """A date from a date, timestamp or ``YYYY-MM-DD…`` text column."""
    return parse_date(F.col(c).cast("string")) if isinstance(c, str) else c


def with_tenure(rows: DataFrame, period_col: str = "period", hire_date="hire_date") -> DataFrame:
    """Add ``period_date``, ``tenure_days_raw``, ``tenure_days``, ``tenure_band``.

    ``tenure_days_raw`` keeps negative values so a quality rule can still see
    them; ``tenure_days`` nulls them (a hire after the period is a data error).
    An existing ``period_date`` column is used as is.
    """
    pd = F.col("period_date") if "period_date" in rows.columns else period_start(F.col(period_col))
    hd = as_date(hire_date)
    raw = F.datediff(pd, hd)  # null when either date is null
    return (
        rows.withColumn("period_date", pd)
        .withColumn("tenure_days_raw", raw.cast("int"))
        .withColumn("tenure_days", non_negative(F.col("tenure_days_raw")))
        .withColumn("tenure_band", tenure_band(F.col("tenure_days")))
    )


def repair_before(df: DataFrame, col: str, floor_col: str) -> DataFrame:
    """Null ``col`` where it is earlier than ``floor_col``; keep the row."""
    bad = F.col(col).isNotNull() & (as_date(col) < as_date(floor_col))
    return df.withColumn(col, F.when(bad, F.lit(None)).otherwise(F.col(col)))


# Amounts keep their cents: text such as "3000.25" is a good amount.
AMOUNT = "decimal(18,2)"


def valid_amounts(df: DataFrame, checks: dict[str, str], cast: str = AMOUNT) -> DataFrame:
    """Keep rows whose amounts parse and satisfy ``op 0`` (``>=`` or ``>``).

    ``checks`` maps column -> ``">="`` or ``">"``; the columns are replaced
    by their numeric values.
    """
    cond = F.lit(True)
    for c, op in checks.items():
        df = df.withColumn(c, F.col(c).try_cast(cast))
        v = F.col(c)
        cond = cond & v.isNotNull() & ((v >= 0) if op == ">=" else (v > 0))
    return df.where(cond)


def payroll_fact(payroll: DataFrame, valid_keys: DataFrame, key: str | Sequence[str],
                 cols: Sequence[str], cast: str = AMOUNT,
                 checks: dict[str, str] | None = None) -> DataFrame:
    """Rows whose key exists in ``valid_keys`` (semi join) with valid amounts."""
    keys = [key] if isinstance(key, str) else list(key)
    checks = checks or {"gross_pay": ">=", "net_pay": ">="}
    valid = valid_keys.select(*keys)
    kept = payroll.where(F.col(keys[0]).isNotNull()).join(valid, keys, "left_semi")
    return valid_amounts(kept, checks, cast).select(*cols)


def optional_column(df: DataFrame, name: str, rescued_col: str = "_rescued_data") -> Column:
    """P10: a column that may be absent from the schema (late arrival).

    Taken from the schema when present, else from the rescued JSON, else null.
    """
    found = F.col(name) if name in df.columns else F.lit(None).cast("string")
    if rescued_col in df.columns:
        return F.coalesce(found.cast("string"), F.get_json_object(F.col(rescued_col), f"$.{name}"))
    return found


def compensation_fact(comp: DataFrame, key: str, salary: str, cols: Sequence[str],
                      optional: Sequence[str] = (), cast: str = AMOUNT,
                      band_edges: Sequence | None = None) -> DataFrame:
    """D7 + F6: valid salaries, optional late columns, salary band."""
    extra = [optional_column(comp, c).alias(c) for c in optional]
    out = comp.where(F.col(key).isNotNull()).select(*[c for c in cols], *extra)
    out = valid_amounts(out, {salary: ">"}, cast)
    band = salary_band(F.col(salary)) if band_edges is None else salary_band(F.col(salary), band_edges)
    return out.withColumn("salary_band", band)
