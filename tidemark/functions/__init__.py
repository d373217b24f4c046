from tidemark.functions.bands import band, pct_2dp, salary_band, tenure_band
from tidemark.functions.calendar import calendar_columns, fiscal_period, fiscal_year
from tidemark.functions.compare import any_changed, same_values
from tidemark.functions.periods import (
    PERIOD_IN_PATH,
    normalize_period,
    parse_date,
    period_from_path,
    period_of,
    period_start,
)

__all__ = [
    "band", "pct_2dp", "salary_band", "tenure_band",
    "calendar_columns", "fiscal_period", "fiscal_year",
    "any_changed", "same_values",
    "PERIOD_IN_PATH", "normalize_period", "parse_date", "period_from_path", "period_of",
    "period_start",
]
