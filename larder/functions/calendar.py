"""Calendar and fiscal-calendar columns.

Days of the week follow Spark: 1 = Sunday ... 7 = Saturday.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FISCAL_START_MONTH = 4
WEEKEND = (1, 7)


def period_start(unit: str, day: Column) -> Column:
    """First day of the week (Monday), month or quarter, as a DATE."""
    return F.date_trunc(unit, day).cast("date")


def fiscal_year(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    """Calendar year in which the fiscal year began."""
    return F.year(F.add_months(day, 1 - start_month))


def fiscal_month(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    """1 for the first month of the fiscal year, 12 for the last."""
    return F.month(F.add_months(day, 1 - start_month))


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(*WEEKEND)


def calendar_columns(day: Column) -> list[Column]:
    """The date dimensions attached to staged sales."""
    return [
        period_start("week", day).alias("week_start"),
        period_start("month", day).alias("month_start"),
        period_start("quarter", day).alias("quarter_start"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofweek(day).alias("day_of_week"),
        F.dayofyear(day).alias("day_of_year"),
        fiscal_year(day).alias("fiscal_year"),
        fiscal_month(day).alias("fiscal_month"),
    ]
