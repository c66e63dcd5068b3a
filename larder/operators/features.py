"""Demand features: lags, trailing windows, calendar and cross-series totals.

Series are keyed by (sku, store_id) and ordered by ``ds``. Window functions sort a
whole partition inside one task, so they are only given frames at daily grain (see
``daily_grain``): a series then has one row per day however many raw rows its
product has, and a (sku, ds) group one row per store.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions import exact_sum, flag
from larder.functions.calendar import is_weekend

SERIES = ("sku", "store_id")
TARGET = "units_sold"
HORIZONS = (7, 14, 30)


def daily_grain(sales: DataFrame) -> DataFrame:
    """One row per (sku, store_id, ds); partial sums are taken before the shuffle."""
    return sales.groupBy(*SERIES, F.col("date").cast("date").alias("ds")).agg(
        F.sum("units_sold").alias("units_sold"),
        F.sum("demand").alias("demand"),
        exact_sum("revenue").alias("revenue"),
        F.max("is_promo").alias("is_promo"),
        F.max("stockout_flag").alias("stockout_flag"),
    )


def lag_columns(
    group: Sequence[str], target: str, lags: Sequence[int], time: str = "ds"
) -> list[Column]:
    series = Window.partitionBy(*group).orderBy(time)
    return [F.lag(target, n).over(series).alias(f"{target}_lag_{n}") for n in lags]


def rolling_columns(
    group: Sequence[str], target: str, spans: Sequence[int], time: str = "ds"
) -> list[Column]:
    """Mean, sample std, min and max of the ``n`` rows before the current one.

    The current row is left out, so no feature sees the value it should predict.
    """
    series = Window.partitionBy(*group).orderBy(time)
    measures = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return [
        measure(target).over(series.rowsBetween(-n, -1)).alias(f"{target}_roll_{name}_{n}")
        for n in spans
        for name, measure in measures.items()
    ]


def add_lag_features(
    df: DataFrame,
    group: Sequence[str] = SERIES,
    target: str = TARGET,
    lags: Sequence[int] = HORIZONS,
) -> DataFrame:
    return df.select("*", *lag_columns(group, target, lags))


def add_rolling_features(
    df: DataFrame,
    group: Sequence[str] = SERIES,
    target: str = TARGET,
    spans: Sequence[int] = HORIZONS,
) -> DataFrame:
    return df.select("*", *rolling_columns(group, target, spans))


def calendar_feature_columns(time: str = "ds") -> list[Column]:
    day = F.col(time)
    return [
        F.dayofweek(day).alias("day_of_week"),
        F.dayofyear(day).alias("day_of_year"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        flag(is_weekend(day)).alias("is_weekend"),
        flag(F.dayofmonth(day) <= 7).alias("is_month_start"),
        flag(F.dayofmonth(day) >= 24).alias("is_month_end"),
    ]


def add_calendar_features(df: DataFrame, time: str = "ds") -> DataFrame:
    return df.select("*", *calendar_feature_columns(time))


def add_cross_totals(
    df: DataFrame, target: str = TARGET, time: str = "ds", among: DataFrame | None = None
) -> DataFrame:
    """Units per (sku, day) over all stores and per (store, day) over all products.

    Totals are summed before they are shuffled and joined back, so a day of a store that
    sells every product is no task of its own: adaptive execution broadcasts the totals or
    splits the join. They are summed over ``among``, the frame itself if not given.
    """
    totals = df
    for key in ("sku", "store_id"):
        name = f"{'sku' if key == 'sku' else 'store'}_total_qty"
        sums = (df if among is None else among).groupBy(key, time).agg(F.sum(target).alias(name))
        totals = totals.join(sums, [key, time])
    return totals.select(*df.columns, "sku_total_qty", "store_total_qty")


def demand_features(daily: DataFrame, min_lag: int = HORIZONS[0]) -> DataFrame:
    """The full feature table from a daily-grain frame.

    Lags and trailing windows share one sort, and come first: a frame that is spread by series
    is not moved for them, and only rows with enough history go on to the cross totals.
    """
    known = daily.na.drop(subset=[*SERIES, "ds"])  # other rows only count in totals
    history = known.select(
        "*",
        *lag_columns(SERIES, TARGET, HORIZONS),
        *rolling_columns(SERIES, TARGET, HORIZONS),
    )
    rows = history.where(F.col(f"{TARGET}_lag_{min_lag}").isNotNull())
    looked_back = [c for c in history.columns if c not in daily.columns]
    return add_cross_totals(rows, among=daily).select(
        *daily.columns,
        "sku_total_qty",
        "store_total_qty",
        *looked_back,
        *calendar_feature_columns(),
    )


def feature_state(daily: DataFrame, rows: int = HORIZONS[-1]) -> DataFrame:
    """The last ``rows`` rows of every series: all that the features of a new day look back on.

    Also the way to extend a state by the rows of new days. Spark keeps a series' last rows in
    each task before it shuffles them.
    """
    latest = Window.partitionBy(*SERIES).orderBy(F.desc("ds"))
    return (
        daily.withColumn("_back", F.row_number().over(latest)).where(F.col("_back") <= rows).drop("_back")
    )


def late_rows(state: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new`` that are not after the last day that the state has of their series."""
    known = state.groupBy(*SERIES).agg(F.max("ds").alias("_known"))
    return new.join(known, list(SERIES)).where(F.col("ds") <= F.col("_known")).select(*new.columns)


def new_features(
    state: DataFrame, new: DataFrame, min_lag: int = HORIZONS[0]
) -> tuple[DataFrame, DataFrame]:
    """(features of the new days, state after them), as a full rebuild would give them.

    ``new`` holds one row per series and day, all after the series' days in the state, or a
    ValueError is raised: earlier days would change features that are already written. Only the
    state and the new rows are read, so a day costs a day however long the history is.
    """
    if not late_rows(state, new).isEmpty():
        raise ValueError("rows at or before the last day of their series")
    names = new.columns
    both = state.select(*names, F.lit(False).alias("_new")).unionByName(
        new.select(*names, F.lit(True).alias("_new"))
    )
    looked_back = both.select(
        "*",
        *lag_columns(SERIES, TARGET, HORIZONS),
        *rolling_columns(SERIES, TARGET, HORIZONS),
    )
    fresh = looked_back.where("_new").drop("_new")
    built = (
        add_cross_totals(new)
        .select(*SERIES, "ds", "sku_total_qty", "store_total_qty")
        .join(fresh, [*SERIES, "ds"])
        .where(F.col(f"{TARGET}_lag_{min_lag}").isNotNull())
        .select("*", *calendar_feature_columns())
    )
    return built, feature_state(both.drop("_new"))


def date_gaps(df: DataFrame, group: Sequence[str] = SERIES, time: str = "ds") -> DataFrame:
    """Rows that follow their predecessor in the series by more than one day."""
    series = Window.partitionBy(*group).orderBy(time)
    previous = F.lag(time).over(series)
    return (
        df.select(*group, time, previous.alias("previous_ds"))
        .withColumn("gap_days", F.datediff(time, "previous_ds"))
        .where(F.col("gap_days") > 1)
    )


def fill_gaps(daily: DataFrame, group: Sequence[str] = SERIES, time: str = "ds") -> DataFrame:
    """Dense calendar: every series gets a row for each day of its own range.

    Instead of crossing all keys with all days, each row produces the days up to the
    next row of its series, so output rows are exactly the dense grid and nothing is
    joined.
    """
    series = Window.partitionBy(*group).orderBy(time)
    until = F.coalesce(F.date_sub(F.lead(time).over(series), 1), F.col(time))
    measures = [c for c in daily.columns if c not in (*group, time)]
    dense = daily.withColumn("_until", until).select(
        *group,
        F.explode(F.sequence(time, "_until")).alias("_day"),
        F.col(time),
        *measures,
    )
    observed = F.col("_day") == F.col(time)
    zero = {
        c: F.lit(False) if t == "boolean" else F.lit(0).cast(t)
        for c, t in daily.dtypes
        if c in measures
    }
    return dense.select(
        *group,
        F.col("_day").alias(time),
        *(F.when(observed, F.col(c)).otherwise(zero[c]).alias(c) for c in measures),
        (~observed).alias("is_filled"),
    )


def group_zscore(df: DataFrame, value: str, group: Sequence[str] = ("sku",)) -> DataFrame:
    """Distance from the group mean in group standard deviations; 0 if they are 0.

    Aggregate-and-join rather than a window: the group may be any share of the rows
    and AQE can split a skewed join, but not a window partition.
    """
    stats = df.groupBy(*group).agg(
        F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std")
    )
    score = F.coalesce(
        F.try_divide(F.col(value) - F.col("_mean"), F.col("_std")), F.lit(0.0)
    )
    return df.join(stats, list(group)).withColumn("zscore", score).drop("_mean", "_std")


def week_over_week(daily_totals: DataFrame, value: str = "revenue", time: str = "ds") -> DataFrame:
    """Change of the last seven days against the seven before, in percent.

    The input has one row per day, so ranking it in a single partition is bounded
    by the length of the calendar.
    """
    recency = F.row_number().over(Window.orderBy(F.col(time).desc()))
    ranked = daily_totals.select(recency.alias("_age"), F.col(value).alias("_v"))
    recent = exact_sum(F.when(F.col("_age") <= 7, F.col("_v")))
    prior = exact_sum(F.when(F.col("_age").between(8, 14), F.col("_v")))
    totals = ranked.agg(
        recent.alias("recent"), prior.alias("prior"), F.count(F.lit(1)).alias("days")
    )
    change = (F.col("recent") - F.col("prior")) / F.col("prior") * 100
    usable = (F.col("days") >= 14) & (F.col("prior") > 0)
    return totals.select(
        "days", "recent", "prior", F.when(usable, change).otherwise(0.0).alias("trend_pct")
    )
