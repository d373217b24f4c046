"""Period and date columns.

A period is a sortable string: ``YYYY-MM`` for monthly snapshots or
``YYYY-MM-DD`` for daily ones. Every text-to-date step uses the ``try_``
forms so malformed input becomes null instead of failing the job under ANSI.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the folder pattern that carries the period in a landing path.
# It accepts both ``/2025-01/`` (one folder per period) and ``/period=2025-01/``
# (a partitioned write), monthly or daily.
PERIOD_IN_PATH = r"[/=](\d{4}-\d{2}(?:-\d{2})?)/"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_from_path(path="_source_file_name", pattern: str = PERIOD_IN_PATH) -> Column:
    """Period taken from a file path; null (not ``''``) when the path has none."""
    return F.nullif(F.regexp_extract(_col(path), pattern, 1), F.lit(""))


def period_of(ts, fmt: str = "yyyy-MM") -> Column:
    """Period string of a date/timestamp column (``yyyy-MM`` or ``yyyy-MM-dd``)."""
    return F.date_format(_col(ts), fmt)


def period_start(period) -> Column:
    """First day of a ``YYYY-MM`` or ``YYYY-MM-DD`` period, as a date."""
    p = _col(period)
    # ``YYYY-MM`` is built from two integers (no formatter, cheap enough to be
    # repeated where Catalyst inlines it into pushed-down filters); other
    # lengths are parsed as ``yyyy-MM-dd``. Malformed text gives null.
    y = F.substring(p, 1, 4).try_cast("int")
    m = F.substring(p, 6, 2).try_cast("int")
    monthly = (F.length(p) == 7) & (F.substring(p, 5, 1) == "-") & m.between(1, 12) & \
        y.between(1, 9999)
    return F.when(monthly, F.make_date(y, m, F.lit(1))).when(
        F.length(p) != 7, F.try_to_date(p, "yyyy-MM-dd"))


def parse_date(text) -> Column:
    """``YYYY-MM-DD`` prefix of a text column as a date, null if malformed."""
    return F.try_to_date(F.substring(_col(text), 1, 10), "yyyy-MM-dd")


def normalize_period(p: str | None) -> str | None:
    """``'2025-1'`` -> ``'2025-01'`` (and ``'2025-1-5'`` -> ``'2025-01-05'``) for
    period parameters typed by hand; other text is returned stripped."""
    if p is None:
        return None
    parts = p.strip().split("-")
    if len(parts) in (2, 3) and all(x.isdigit() for x in parts):
        return "-".join([parts[0].zfill(4)] + [x.zfill(2) for x in parts[1:]])
    return p.strip()
