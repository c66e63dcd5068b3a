"""Report queries over sales, features and gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import exact_sum, period_start, ratio, round_to
from larder.operators.staging import last_days


def _active(*, skus: str = "active_skus", stores: str = "active_stores") -> list[Column]:
    return [F.count_distinct("sku").alias(skus), F.count_distinct("store_id").alias(stores)]


def top(df: DataFrame, by: str, n: int, tie: str | Sequence[str], largest: bool = True) -> DataFrame:
    """First ``n`` rows by a measure, ties settled by key; never sorts the whole input."""
    ties = [tie] if isinstance(tie, str) else list(tie)
    return df.orderBy(F.desc(by) if largest else F.asc(by), *ties).limit(n)


def daily_totals(features: DataFrame) -> DataFrame:
    return features.groupBy("ds").agg(
        exact_sum("revenue").alias("revenue"), F.sum("units_sold").alias("units_sold"), *_active()
    )


def kpi_header(totals: DataFrame) -> DataFrame:
    """Headline figures over the daily totals."""
    return totals.agg(
        exact_sum("revenue").alias("total_revenue"),
        F.sum("units_sold").alias("total_units"),
        round_to(exact_sum("revenue") / F.count("revenue"), 4).alias("avg_daily_revenue"),
        F.max("active_skus").alias("active_skus"),
    )


def performance(features: DataFrame, key: str) -> DataFrame:
    return features.groupBy(key).agg(
        exact_sum("revenue").alias("revenue"), F.sum("units_sold").alias("units")
    )


def top_products(features: DataFrame, n: int = 20) -> DataFrame:
    summed = features.groupBy("sku").agg(
        exact_sum("revenue").alias("total_revenue"),
        F.sum("units_sold").alias("total_units"),
        round_to(F.avg("units_sold"), 4).alias("avg_daily_units"),
    )
    return top(summed, "total_revenue", n, "sku")


def product_summary(features: DataFrame) -> DataFrame:
    return features.groupBy("sku").agg(
        F.sum("units_sold").alias("total_units"),
        round_to(F.avg("units_sold"), 2).alias("avg_daily"),
        round_to(F.stddev_samp("units_sold"), 2).alias("std_dev"),
        round_to(exact_sum("revenue"), 2).alias("total_revenue"),
    )


def store_summary(features: DataFrame) -> DataFrame:
    return features.groupBy("store_id").agg(
        F.sum("units_sold").alias("total_units"),
        exact_sum("revenue").alias("total_revenue"),
        F.count_distinct("sku").alias("unique_skus"),
    )


def monthly_trend(monthly: DataFrame) -> DataFrame:
    """Revenue and units per month, from the monthly gold table."""
    return monthly.groupBy("month_start").agg(
        exact_sum("total_revenue").alias("revenue"), F.sum("total_units").alias("units")
    )


def monthly_trend_raw(sales: DataFrame) -> DataFrame:
    """The same from raw sales, with stockout events."""
    return sales.groupBy(period_start("month", F.col("date")).alias("month")).agg(
        round_to(exact_sum("revenue"), 2).alias("revenue"),
        F.sum("units_sold").alias("units"),
        F.count_if("stockout_flag").alias("stockout_events"),
    )


def revenue_by_category(sales: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """Sales are summed per product before the join: one row per product travels."""
    per_sku = sales.groupBy("sku").agg(
        exact_sum("revenue").alias("revenue"), F.sum("units_sold").alias("units")
    )
    summed = (
        per_sku.join(products.select("sku", "category"), "sku")
        .groupBy("category")
        .agg(
            round_to(exact_sum("revenue"), 2).alias("total_revenue"),
            F.sum("units").alias("total_units"),
        )
    )
    return top(summed, "total_revenue", n, "category")


def supplier_delays(orders: DataFrame, n: int = 10) -> DataFrame:
    """Delivered orders, mean delay and late orders per supplier, worst first."""
    summed = (
        orders.where(F.col("delay_days").isNotNull())
        .groupBy("supplier_id")
        .agg(
            F.count(F.lit(1)).alias("total_pos"),
            round_to(F.avg("delay_days"), 1).alias("avg_delay"),
            F.count_if(F.col("delay_days") > 0).alias("delayed_pos"),
        )
    )
    return top(summed, "avg_delay", n, "supplier_id")


def products_by_class(products: DataFrame) -> DataFrame:
    return products.groupBy("abc_class").agg(F.count(F.lit(1)).alias("cnt"))


def top_selling(sales: DataFrame, n: int = 10) -> DataFrame:
    summed = sales.groupBy("sku").agg(
        exact_sum("revenue").alias("total_revenue"),
        F.sum("units_sold").alias("total_units"),
        F.count(F.lit(1)).alias("transactions"),
    )
    return top(summed, "total_revenue", n, "sku")


def overview(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count(F.lit(1)).alias("total_records"),
        *_active(skus="unique_skus", stores="unique_stores"),
        F.min("ds").alias("date_from"),
        F.max("ds").alias("date_to"),
        exact_sum("revenue").alias("total_revenue"),
    )


def period_kpis(features: DataFrame, days: int = 30) -> DataFrame:
    return last_days(features, days).agg(
        exact_sum("revenue").alias("total_revenue"),
        F.sum("units_sold").alias("total_units"),
        *_active(),
        F.count(F.lit(1)).alias("transactions"),
        round_to(F.avg("units_sold"), 4).alias("avg_daily_units"),
    )


def period_performers(
    features: DataFrame, key: str, days: int = 30, n: int = 5, largest: bool = True
) -> DataFrame:
    return top(performance(last_days(features, days), key), "revenue", n, key, largest)


def period_trend(features: DataFrame, days: int = 30) -> DataFrame:
    return (
        last_days(features, days)
        .groupBy("ds")
        .agg(
            exact_sum("revenue").alias("daily_revenue"), F.sum("units_sold").alias("daily_units")
        )
    )


def period_anomalies(anomalies: DataFrame, days: int = 30) -> DataFrame:
    """Anomalies of the last days; the period ends at the latest row, flagged or not."""
    return (
        last_days(anomalies.select("ds", "sku", "is_anomaly"), days)
        .where("is_anomaly = 1")
        .agg(
            F.count(F.lit(1)).alias("total_anomalies"),
            F.count_distinct("sku").alias("affected_skus"),
        )
    )


def units_by_weekday(features: DataFrame) -> DataFrame:
    return features.groupBy("day_of_week").agg(round_to(F.avg("units_sold"), 4).alias("avg_units"))


def revenue_above(features: DataFrame, threshold: float = 10_000) -> DataFrame:
    summed = features.groupBy("sku").agg(exact_sum("revenue").alias("revenue"))
    return summed.where(F.col("revenue") > threshold)


def sales_kpis(sales: DataFrame) -> DataFrame:
    price = ratio("revenue", "units_sold")
    return sales.agg(
        exact_sum("revenue").alias("total_revenue"),
        F.sum("units_sold").alias("total_units"),
        round_to(F.avg(price), 4).alias("avg_price"),
        F.count_distinct("sku").alias("unique_skus"),
    )


def weekly_demand(daily: DataFrame) -> DataFrame:
    return daily.groupBy(
        period_start("week", F.col("ds")).alias("forecast_date"), "store_id", "sku"
    ).agg(F.sum("demand").alias("actual_qty"))


def forecast_vs_actual(forecasts: DataFrame, daily: DataFrame) -> DataFrame:
    """Weekly forecasts beside actual demand, with the error of each row."""
    error = F.abs(F.col("actual_qty") - F.col("forecast_qty"))
    return forecasts.join(weekly_demand(daily), ["forecast_date", "store_id", "sku"]).select(
        "forecast_date",
        "store_id",
        "sku",
        "forecast_qty",
        "actual_qty",
        round_to(ratio(error, "actual_qty") * 100, 2).alias("mape"),
    )


def replenishment(
    sales: DataFrame, supplier_map: DataFrame, suppliers: DataFrame, buffer: float = 1.1
) -> DataFrame:
    """Monthly order quantity per product: demand plus buffer in whole order lots."""
    monthly = sales.groupBy(period_start("month", F.col("date")).alias("month"), "sku").agg(
        F.sum("demand").alias("demand")
    )
    terms = primary_supplier_terms(supplier_map, suppliers)
    lot = F.col("min_order_qty")
    lots = F.ceil(F.round(F.col("demand") * buffer / lot, 9))
    return monthly.join(terms, "sku").select(
        "month",
        "sku",
        "supplier_id",
        "demand",
        F.greatest(lot, lots * lot).alias("order_qty"),
    )


def primary_supplier_terms(supplier_map: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Terms of the primary supplier of each product."""
    primary = supplier_map.where("is_primary").select("sku", "supplier_id")
    terms = suppliers.select("supplier_id", "min_order_qty", "lead_time_days", "payment_terms_days")
    return primary.join(terms, "supplier_id")


def best_products(product_performance: DataFrame, n: int = 10) -> DataFrame:
    return top(product_performance, "lifetime_revenue", n, "sku").select(
        "sku", "product_name", "abc_class", "lifetime_revenue", "service_level"
    )


def recent_rows(df: DataFrame, n: int, tie: Sequence[str], time: str = "ds") -> DataFrame:
    return top(df, time, n, tie)


def domain(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def extreme_row(df: DataFrame, by: str, tie: str, largest: bool = True) -> DataFrame:
    """The whole row that holds the extreme of a measure, as an aggregate (no sort)."""
    pick = F.max_by if largest else F.min_by
    row = F.struct(*df.columns)
    return df.agg(pick(row, F.struct(by, tie)).alias("row")).select("row.*")
