"""Gold layer: period facts per store and product, and the product dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import exact_sum, exact_sum_if, percent, ratio, round_to


def _volume() -> list[Column]:
    return [
        F.sum("units_sold").alias("total_units"),
        F.sum("demand").alias("total_demand"),
        F.sum("lost_sales").alias("total_lost_sales"),
        round_to(exact_sum("revenue"), 2).alias("total_revenue"),
        F.sum(F.when(F.col("is_promo"), F.col("units_sold")).otherwise(0)).alias("promo_units"),
        round_to(exact_sum_if("is_promo", "revenue"), 2).alias("promo_revenue"),
        F.count_if("stockout_flag").alias("stockout_days"),
    ]


def _fill_rate() -> Column:
    return percent(F.sum("units_sold"), F.sum("demand")).alias("fill_rate")


def weekly_sales(staged: DataFrame) -> DataFrame:
    return staged.groupBy("week_start", "store_id", "sku").agg(
        *_volume(),
        percent(F.sum("lost_sales"), F.sum("demand")).alias("lost_sales_pct"),
        _fill_rate(),
        round_to(F.avg("units_sold"), 2).alias("avg_daily_units"),
        round_to(exact_sum("revenue") / F.count("revenue"), 2).alias("avg_daily_revenue"),
        F.count(F.lit(1)).alias("num_days"),
    )


def monthly_sales(staged: DataFrame) -> DataFrame:
    return staged.groupBy("month_start", "year", "month", "store_id", "sku").agg(
        *_volume(),
        F.count(F.lit(1)).alias("total_days"),
        percent(F.count_if("stockout_flag"), F.count(F.lit(1))).alias("stockout_rate"),
        _fill_rate(),
    )


def product_performance(
    products: DataFrame, monthly: DataFrame, inventory: DataFrame
) -> DataFrame:
    """One row per staged product with lifetime sales and stock health.

    Both summaries are at product grain before the joins, so a hot product costs
    one row per join side. Monthly rows, one per store and month of a product, are moved once
    and as they are: sums per product and store would be as many, and wider.
    """
    rows = monthly.select(
        "sku",
        "store_id",
        "month_start",
        "total_units",
        "total_revenue",
        "stockout_days",
        "total_days",
        "fill_rate",
    ).repartition("sku")
    sold = rows.groupBy("sku").agg(
        F.sum("total_units").alias("lifetime_units"),
        exact_sum("total_revenue").alias("lifetime_revenue"),
        F.sum("stockout_days").alias("stockout_days"),
        F.sum("total_days").alias("total_days"),
        F.countDistinct("store_id").alias("num_stores"),
        F.min("month_start").alias("first_sale_date"),
        F.max("month_start").alias("last_sale_date"),
        (exact_sum("fill_rate") / F.count("fill_rate")).alias("avg_fill_rate"),
    )
    stocked = inventory.groupBy("sku").agg(
        F.avg("on_hand_qty").alias("avg_on_hand"),
        (exact_sum("inventory_value") / F.count("inventory_value")).alias("avg_inventory_value"),
        F.count_if("is_stockout").alias("stockout_snapshots"),
        F.count(F.lit(1)).alias("total_snapshots"),
    )

    def known(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    out_share = ratio(known("stockout_days"), "total_days") * 100
    return (
        products.join(sold, "sku", "left")
        .join(stocked, "sku", "left")
        .select(
            "sku",
            "product_name",
            "category",
            "abc_class",
            "unit_cost",
            "unit_price",
            "margin_pct",
            known("lifetime_units").alias("lifetime_units"),
            known("lifetime_revenue").alias("lifetime_revenue"),
            known("num_stores").alias("num_stores"),
            "first_sale_date",
            "last_sale_date",
            round_to(known("avg_fill_rate"), 4).alias("avg_fill_rate"),
            round_to(known("avg_on_hand"), 4).alias("avg_on_hand"),
            round_to(known("avg_inventory_value"), 4).alias("avg_inventory_value"),
            round_to(out_share, 2).alias("stockout_rate"),
            round_to(100 - out_share, 2).alias("service_level"),
            percent("stockout_snapshots", "total_snapshots").alias("inventory_stockout_rate"),
        )
    )


def daily_sku_sales(sales: DataFrame) -> DataFrame:
    """Units, revenue and mean unit price per day and product."""
    priced = sales.withColumn("unit_price", ratio("revenue", "units_sold"))
    return priced.groupBy(F.col("date").alias("ds"), "sku").agg(
        F.sum("units_sold").alias("total_units"),
        exact_sum("revenue").alias("total_revenue"),
        round_to(F.avg("unit_price"), 4).alias("avg_price"),
    )
