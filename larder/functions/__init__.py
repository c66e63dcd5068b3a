"""Column-level building blocks (no UDFs; everything stays in codegen)."""

from larder.functions.calendar import (
    calendar_columns,
    fiscal_month,
    fiscal_year,
    period_start,
)
from larder.functions.numeric import (
    exact_sum,
    exact_sum_if,
    flag,
    percent,
    ratio,
    round_to,
    snap,
    zero_as,
)

__all__ = [
    "calendar_columns",
    "exact_sum",
    "exact_sum_if",
    "fiscal_month",
    "fiscal_year",
    "flag",
    "percent",
    "period_start",
    "ratio",
    "round_to",
    "snap",
    "zero_as",
]
