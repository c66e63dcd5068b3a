"""Silver layer: typed rows with derived columns. Projections and filters only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import calendar_columns, percent, period_start

LOW_STOCK_BELOW = 50

# Reliability tiers, best first: (lowest score, label). Fixed by the data model.
RELIABILITY_TIERS = ((0.95, "Excellent"), (0.85, "Good"), (0.70, "Fair"))
RELIABILITY_FLOOR = "Poor"


def banded(value: Column, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first band whose lower bound ``value`` reaches."""
    labels = F.coalesce(*(F.when(value >= low, F.lit(label)) for low, label in bands))
    return F.coalesce(labels, F.lit(otherwise))


def stage_products(products: DataFrame) -> DataFrame:
    margin = F.col("unit_price") - F.col("unit_cost")
    return products.select(
        "*",
        margin.alias("unit_margin"),
        percent(margin, "unit_price").alias("margin_pct"),
    )


def stage_suppliers(suppliers: DataFrame) -> DataFrame:
    """Adds the reliability tier; an unknown score falls in the lowest tier."""
    tier = banded(F.col("reliability_score"), RELIABILITY_TIERS, RELIABILITY_FLOOR)
    return suppliers.select("*", tier.alias("reliability_tier"))


def stage_sales(sales: DataFrame) -> DataFrame:
    day = F.col("date")
    return sales.where(F.col("units_sold").isNotNull()).select(
        "date",
        "store_id",
        "sku",
        "units_sold",
        "demand",
        (F.col("demand") - F.col("units_sold")).alias("lost_sales"),
        "revenue",
        "is_promo",
        "stockout_flag",
        *calendar_columns(day),
    )


def stage_inventory(inventory: DataFrame) -> DataFrame:
    def quantity(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    on_hand, snapshot = F.col("on_hand_qty"), F.col("snapshot_date")
    available = quantity("on_hand_qty") + quantity("in_transit_qty")
    return inventory.where(on_hand.isNotNull()).select(
        "snapshot_date",
        "location_id",
        "sku",
        "on_hand_qty",
        "in_transit_qty",
        "backorder_qty",
        "inventory_value",
        available.alias("total_available_qty"),
        (available - quantity("backorder_qty")).alias("net_position"),
        (on_hand == 0).alias("is_stockout"),
        (on_hand < LOW_STOCK_BELOW).alias("is_low_stock"),
        period_start("month", snapshot).alias("month_start"),
        F.year(snapshot).alias("year"),
        F.month(snapshot).alias("month"),
    )


def plausible_sales(sales: DataFrame) -> DataFrame:
    """Rows with non-negative units and revenue."""
    return sales.where((F.col("units_sold") >= 0) & (F.col("revenue") >= 0))


def complete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns)


def fill_missing(df: DataFrame, columns: list[str], value: float = 0) -> DataFrame:
    return df.na.fill(value, subset=columns)


def between_dates(
    df: DataFrame, start: str | None = None, end: str | None = None, column: str = "ds"
) -> DataFrame:
    """Rows with start <= column <= end; either bound may be left open."""
    bounds = []
    if start is not None:
        bounds.append(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        bounds.append(F.col(column) <= F.lit(end).cast("date"))
    return df.where(reduce(Column.__and__, bounds)) if bounds else df


def before_date(df: DataFrame, cutoff: str, column: str = "ds") -> DataFrame:
    return df.where(F.col(column) < F.lit(cutoff).cast("date"))


def last_days(df: DataFrame, days: int, column: str = "ds") -> DataFrame:
    """Rows no more than ``days`` before the latest date in the frame.

    A scalar subquery is evaluated before the main scan starts, so on a stored table
    its value still prunes files and row groups, which a join would not.
    """
    first = df.agg(F.date_sub(F.max(column), days)).scalar()
    return df.where(F.col(column) >= first)


def any_flag(columns: list[str]) -> Column:
    """True when at least one 0/1 flag of the row is set."""
    flags = [F.coalesce(F.col(c), F.lit(0)) for c in columns]
    return (flags[0] if len(flags) == 1 else F.greatest(*flags)) == 1


def with_commercials(sales: DataFrame, products: DataFrame, discount: str) -> DataFrame:
    """Cost of goods, gross profit and discounted revenue per sales row."""
    terms = products.select("sku", "unit_cost", "unit_price")
    gross = F.col("units_sold") * F.col("unit_price")
    cogs = F.col("units_sold") * F.col("unit_cost")
    net = gross * (1 - F.col(discount))
    return sales.join(terms, "sku").select(
        *sales.columns,
        cogs.alias("cogs"),
        net.alias("net_revenue"),
        (net - cogs).alias("gross_profit"),
    )


def with_stock_value(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """Value of the units on hand at cost."""
    cost = products.select("sku", "unit_cost")
    value = F.col("on_hand_qty") * F.col("unit_cost")
    return inventory.join(cost, "sku").select(
        *(c for c in inventory.columns if c != "inventory_value"), value.alias("inventory_value")
    )


def with_order_status(orders: DataFrame, as_of: str) -> DataFrame:
    """Purchase-order status on a given day, and days late when delivered.

    Passing the day in, instead of reading the clock, keeps reruns identical.
    """
    today = F.lit(as_of).cast("date")
    arrived = F.col("actual_date") <= today
    status = (
        F.when(arrived, "DELIVERED")
        .when(F.col("order_date") <= today, "IN_TRANSIT")
        .otherwise("PLANNED")
    )
    delay = F.when(arrived, F.datediff("actual_date", "expected_date"))
    return orders.select("*", status.alias("status"), delay.alias("delay_days"))


def severity(null_pct: Column) -> Column:
    return F.when(null_pct > 10, "HIGH").when(null_pct > 5, "MEDIUM").otherwise("LOW")
