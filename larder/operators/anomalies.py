"""Anomaly flags over the demand features, and the reports on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions import flag, percent, zero_as
from larder.operators.ranks import approx_quantiles, exact_quantiles

ISOLATION = "anomaly_isolation_forest"

# Flag columns of the anomaly table, in report order. Fixed by the data model.
FLAGS = (
    "anomaly_demand_zscore",
    "anomaly_demand_iqr",
    "anomaly_demand_contextual",
    "anomaly_stockout",
    "anomaly_high_lost_sales",
    "anomaly_revenue_zscore",
    "anomaly_revenue_iqr",
    ISOLATION,
)
KEYS = ("ds", "sku", "store_id")
MEASURES = ("units_sold", "revenue")
INPUTS = (
    "units_sold",
    "demand",
    "revenue",
    "stockout_flag",
    "units_sold_roll_mean_7",
    "units_sold_roll_std_7",
)
QUARTILES = {"q1": 0.25, "q3": 0.75}


def moments(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """One row with mean and sample standard deviation of each column."""
    return df.agg(
        *(F.avg(c).alias(f"{c}_mean") for c in columns),
        *(F.stddev_samp(c).alias(f"{c}_std") for c in columns),
    )


def global_stats(
    df: DataFrame, columns: Sequence[str] = MEASURES, exact: bool = True
) -> DataFrame:
    """One row of moments and quartiles for all columns."""
    quantiles = exact_quantiles if exact else approx_quantiles
    return moments(df, columns).crossJoin(F.broadcast(quantiles(df, columns, QUARTILES)))


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put a single row of statistics next to every row; one row always broadcasts."""
    return df.crossJoin(F.broadcast(one_row))


def zscore_flag(column: str, threshold: float = 3.0) -> Column:
    """Needs ``<column>_mean`` and ``<column>_std`` beside the value."""
    distance = F.abs(F.col(column) - F.col(f"{column}_mean"))
    return flag(F.try_divide(distance, f"{column}_std") > threshold)


def iqr_flag(column: str, multiplier: float = 1.5) -> Column:
    """Needs ``<column>_q1`` and ``<column>_q3`` beside the value."""
    q1, q3 = F.col(f"{column}_q1"), F.col(f"{column}_q3")
    fence = (q3 - q1) * multiplier
    return flag((F.col(column) < q1 - fence) | (F.col(column) > q3 + fence))


def _divisor(column: str, zero_divisor: str) -> Column:
    """'one' divides by 1 when the divisor is 0; 'null' makes the result unknown."""
    if zero_divisor not in ("one", "null"):
        raise ValueError("zero_divisor is 'one' or 'null'")
    return zero_as(F.col(column).cast("double"), 1.0 if zero_divisor == "one" else None)


def demand_deviation(zero_divisor: str = "one") -> Column:
    """Distance from the trailing week's mean in its standard deviations."""
    surprise = F.col("units_sold") - F.col("units_sold_roll_mean_7")
    return surprise / _divisor("units_sold_roll_std_7", zero_divisor)


def lost_sales_ratio(zero_divisor: str = "one") -> Column:
    return F.col("demand") / _divisor("units_sold", zero_divisor) - 1


def flag_anomalies(
    features: DataFrame,
    stats: DataFrame,
    isolation: DataFrame | None = None,
    zero_divisor: str = "one",
) -> DataFrame:
    """The anomaly table: flags, their sum, and the verdict (two or more flags).

    ``stats`` is the row from ``global_stats``. ``isolation`` is an optional frame of
    keys with the isolation-forest flag. Without it the flag is taken from ``features``
    if it has that column, and is 0 otherwise. Apart from the optional join this is one
    narrow projection.
    """
    rows = attach(features, stats)
    if isolation is None and ISOLATION not in features.columns:
        rows = rows.withColumn(ISOLATION, F.lit(0))
    elif isolation is not None:
        unique = isolation.groupBy(*KEYS).agg(F.max(ISOLATION).alias(ISOLATION))
        rows = rows.join(unique, list(KEYS), "left").fillna(0, [ISOLATION])
    flags = {
        "anomaly_demand_zscore": zscore_flag("units_sold"),
        "anomaly_demand_iqr": iqr_flag("units_sold"),
        "anomaly_demand_contextual": flag(F.abs(demand_deviation(zero_divisor)) > 2.5),
        "anomaly_stockout": F.coalesce(F.col("stockout_flag").cast("int"), F.lit(0)),
        "anomaly_high_lost_sales": flag(lost_sales_ratio(zero_divisor) > 0.2),
        "anomaly_revenue_zscore": zscore_flag("revenue"),
        "anomaly_revenue_iqr": iqr_flag("revenue"),
        ISOLATION: F.col(ISOLATION),
    }
    flagged = rows.select(
        *(c for c in features.columns if c not in FLAGS),
        demand_deviation(zero_divisor).alias("demand_deviation"),
        lost_sales_ratio(zero_divisor).alias("lost_sales_ratio"),
        *(flags[name].alias(name) for name in FLAGS),
    )
    return with_verdict(flagged)


def with_verdict(flagged: DataFrame, flags: Sequence[str] = FLAGS, least: int = 2) -> DataFrame:
    score = sum((F.coalesce(F.col(f), F.lit(0)) for f in flags), F.lit(0))
    return flagged.withColumn("anomaly_score", score).withColumn(
        "is_anomaly", flag(F.col("anomaly_score") >= least)
    )


# -- reports -----------------------------------------------------------------


def flag_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Set count and share of every flag, from one scan.

    All flags are counted in a single aggregate; its one row is then turned into
    one row per flag. ``columns`` defaults to every column with 'anomaly' in its
    name that holds a 0/1 or boolean value.
    """
    if columns is None:
        columns = [
            c
            for c, t in df.dtypes
            if "anomaly" in c and c != "anomaly_score" and t in ("int", "bigint", "boolean")
        ]
    counted = df.agg(
        *(F.count_if(F.col(c).cast("int") == 1).alias(c) for c in columns),
        F.count(F.lit(1)).alias("_rows"),
    )
    rows = F.array(
        *(F.struct(F.lit(c).alias("anomaly_type"), F.col(c).alias("count")) for c in columns)
    )
    return counted.select("_rows", F.inline(rows)).select(
        "anomaly_type", "count", percent("count", "_rows").alias("pct")
    )


def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    return flag_counts(anomalies, [*FLAGS, "is_anomaly"]).withColumn(
        "anomaly_type",
        F.when(F.col("anomaly_type") == "is_anomaly", "total_flagged").otherwise(
            F.col("anomaly_type")
        ),
    )


def top_anomalies(anomalies: DataFrame, limit: int = 100) -> DataFrame:
    return (
        anomalies.where("is_anomaly = 1")
        .orderBy(F.desc("anomaly_score"), F.desc("ds"), "sku", "store_id")
        .limit(limit)
        .select(*KEYS, "units_sold", "demand", "revenue", "anomaly_score", "is_anomaly", *FLAGS)
    )


def anomalies_by(anomalies: DataFrame, key: str, limit: int | None = 50) -> DataFrame:
    """Records, anomalies and anomaly share per key, most anomalies first."""
    counted = anomalies.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_records"), F.sum("is_anomaly").alias("anomaly_count")
    )
    rated = counted.withColumn("anomaly_pct", percent("anomaly_count", "total_records"))
    return rated if limit is None else rated.orderBy(F.desc("anomaly_count"), key).limit(limit)


def rank_by_rate(anomalies: DataFrame, key: str, limit: int = 50) -> DataFrame:
    rated = anomalies_by(anomalies, key, limit=None)
    return rated.orderBy(F.desc("anomaly_pct"), key).limit(limit)


def anomalies_by_date(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy(F.col("ds").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("total_records"), F.sum("is_anomaly").alias("anomaly_count")
    )


def anomaly_rate(anomalies: DataFrame) -> DataFrame:
    return anomalies.agg(
        F.count(F.lit(1)).alias("total_records"), F.sum("is_anomaly").alias("total_anomalies")
    ).withColumn("anomaly_rate", percent("total_anomalies", "total_records"))


def deviation_ranking(features: DataFrame, limit: int) -> DataFrame:
    """Largest deviations from the trailing mean, for use without an anomaly table."""
    score = F.abs(F.col("units_sold") - F.col("units_sold_roll_mean_7")) / F.col(
        "units_sold_roll_std_7"
    )
    return (
        features.where(F.col("units_sold_roll_std_7") > 0)
        .select("sku", "store_id", "ds", score.alias("anomaly_score"))
        .orderBy(F.desc("anomaly_score"), "ds", "sku", "store_id")
        .limit(limit)
    )


def outlier_counts(df: DataFrame, columns: Sequence[str], stats: DataFrame) -> DataFrame:
    """Values outside three standard deviations, and outside the quartile fences."""
    counted = attach(df, stats).agg(
        *(F.sum(zscore_flag(c)).alias(f"{c}_z") for c in columns),
        *(F.sum(iqr_flag(c)).alias(f"{c}_i") for c in columns),
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"{c}_z").alias("zscore_outliers"),
                F.col(f"{c}_i").alias("iqr_outliers"),
            )
            for c in columns
        )
    )
    return counted.select(F.inline(rows))


def anomaly_types(flags: Sequence[str] = FLAGS) -> Column:
    """Names of the flags set on a row, as an array."""
    names = F.array(*(F.when(F.col(f) == 1, F.lit(f.removeprefix("anomaly_"))) for f in flags))
    return F.array_compact(names)


def nearby_history(
    events: DataFrame, history: DataFrame, before: int = 7, after: int = 1
) -> DataFrame:
    """History rows from ``before`` days ahead of each event to ``after`` days past it.

    Every event lists the days it covers (a fixed handful), which turns the range
    condition into an equality on (sku, store_id, day): no event is compared with
    the rest of its series.
    """
    days = F.sequence(F.date_sub("event_ds", before), F.date_add("event_ds", after))
    wanted = events.select(
        "sku", "store_id", F.col("ds").cast("date").alias("event_ds")
    ).select("sku", "store_id", "event_ds", F.explode(days).alias("ds"))
    return wanted.join(history, ["sku", "store_id", "ds"])


def anomaly_context(anomalies: DataFrame, before: int = 7, after: int = 1) -> DataFrame:
    """One row per anomaly: its record, the surrounding days and the series baseline.

    Context and baseline both live in the anomaly's own series, so one window pass
    over the daily series yields them without a join.
    """
    series = Window.partitionBy("sku", "store_id")
    day = F.unix_date(F.col("ds").cast("date"))
    around = series.orderBy("_day").rangeBetween(-before, after)
    record = F.struct("ds", "units_sold", "revenue", "demand")
    return (
        anomalies.withColumn("_day", day)
        .select(
            *KEYS,
            "units_sold",
            "demand",
            "revenue",
            "anomaly_score",
            "is_anomaly",
            anomaly_types().alias("anomaly_types"),
            F.collect_list(record).over(around).alias("history"),
            F.avg("units_sold").over(series).alias("avg_units"),
            F.stddev_samp("units_sold").over(series).alias("std_units"),
            F.avg("revenue").over(series).alias("avg_revenue"),
        )
        .where("is_anomaly = 1")
        .withColumn("history", F.array_sort("history"))
    )
