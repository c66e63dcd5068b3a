"""Demand segmentation of products and stores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import percent, ratio
from larder.operators.ranks import running_totals

MAX_CV = 1.5
MIN_NONZERO_SHARE = 0.3
MIN_VOLUME = {"sku": 100, "store_id": 500}

# Upper bound of the cumulative volume share of each class. Fixed by the data model.
ABC_BOUNDS = (("A", 0.7), ("B", 0.9))


def demand_profile(df: DataFrame, key: str, target: str = "units_sold") -> DataFrame:
    """Volume, level, spread and intermittency of demand per key."""
    return (
        df.groupBy(key)
        .agg(
            F.sum(target).alias("total_volume"),
            F.avg(target).alias("mean_demand"),
            F.stddev_samp(target).alias("std_demand"),
            F.count(target).alias("n_days"),
            F.count_if(F.col(target) > 0).alias("nonzero_days"),
        )
        .withColumns(
            {
                "cv": ratio("std_demand", "mean_demand"),
                "nonzero_pct": ratio("nonzero_days", "n_days"),
            }
        )
    )


def segment(
    df: DataFrame,
    key: str,
    min_volume: float | None = None,
    max_cv: float = MAX_CV,
    min_nonzero: float = MIN_NONZERO_SHARE,
) -> DataFrame:
    """Demand profile with the 'forecastable' verdict; unknown spread is a no."""
    volume = MIN_VOLUME[key] if min_volume is None else min_volume
    regular = (
        (F.col("total_volume") >= volume)
        & (F.col("cv") <= max_cv)
        & (F.col("nonzero_pct") >= min_nonzero)
    )
    return demand_profile(df, key).withColumn(
        "forecastable", F.coalesce(regular, F.lit(False))
    )


def pareto(segments: DataFrame, key: str = "sku") -> DataFrame:
    """Cumulative volume share from the largest item down, ties by key, and ABC class."""
    ranked = running_totals(segments, [F.desc("total_volume"), key], {"volume": "total_volume"})
    share = F.least(ratio("volume_through", "volume_total"), F.lit(1.0))
    # The last class is 'C'; a share is unknown only when nothing was sold at all.
    label = F.when(share.isNotNull(), F.lit("C"))
    for name, bound in reversed(ABC_BOUNDS):
        label = F.when(share <= bound, F.lit(name)).otherwise(label)
    return ranked.select(
        *segments.columns, share.alias("cumulative_pct"), label.alias("abc_class")
    )


def segment_products(features: DataFrame) -> DataFrame:
    return pareto(segment(features, "sku"))


def segment_stores(features: DataFrame) -> DataFrame:
    return segment(features, "store_id")


def segment_counts(products: DataFrame, stores: DataFrame) -> DataFrame:
    """Forecastable share of products and stores, as (entity, total, forecastable, pct)."""

    def counted(df: DataFrame, entity: str) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("total"), F.count_if("forecastable").alias("forecastable")
        ).select(
            F.lit(entity).alias("entity"),
            "total",
            "forecastable",
            percent("forecastable", "total").alias("pct"),
        )

    return counted(products, "sku").unionByName(counted(stores, "store_id"))


def class_counts(products: DataFrame) -> DataFrame:
    return products.groupBy("abc_class").agg(F.count(F.lit(1)).alias("skus"))


def forecastable_rows(df: DataFrame, segments: DataFrame, key: str = "sku") -> DataFrame:
    """Rows whose product (or store) is forecastable."""
    return df.join(segments.where("forecastable").select(key), key, "left_semi")


def volume_coverage(segments: DataFrame) -> DataFrame:
    """Share of all units sold by forecastable items."""
    covered = F.sum(F.when(F.col("forecastable"), F.col("total_volume")).otherwise(0))
    return segments.agg(
        covered.alias("forecastable_volume"), F.sum("total_volume").alias("total_volume")
    ).withColumn("coverage_pct", percent("forecastable_volume", "total_volume"))
