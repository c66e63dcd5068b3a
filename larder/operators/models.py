"""Demand models on Spark ML, and per-series exponential smoothing."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.anomalies import attach
from larder.operators.staging import complete_rows

TARGET = "units_sold"
INPUTS = (
    "day_of_week",
    "day_of_year",
    "month",
    "is_promo",
    "units_sold_lag_7",
    "units_sold_lag_14",
    "units_sold_lag_30",
    "units_sold_roll_mean_7",
    "units_sold_roll_std_7",
    "units_sold_roll_mean_14",
    "units_sold_roll_std_14",
    "units_sold_roll_mean_30",
    "units_sold_roll_std_30",
)

# Two tree configurations. Fixed values.
PLAIN_TREES = {"maxIter": 100, "maxDepth": 6, "stepSize": 0.1, "seed": 42}
SAMPLED_TREES = {
    "maxIter": 200,
    "maxDepth": 6,
    "stepSize": 0.1,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "seed": 42,
}

SEASON = 7


def mark_test_rows(df: DataFrame, train_share: float = 0.8, time: str = "ds") -> DataFrame:
    """Add ``is_test``: rows at or after the time quantile.

    Rows are counted per day first, so what one task ranks is a row per day.
    """
    day = F.unix_date(F.col(time).cast("date"))
    days = df.groupBy(day.alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    cut = days.agg(F.percentile("_day", train_share, F.col("_n")).alias("_cut"))
    return attach(df, cut).withColumn("is_test", day >= F.col("_cut")).drop("_cut")


def model_rows(features: DataFrame, inputs: Sequence[str] = INPUTS) -> DataFrame:
    """Rows with every input known, inputs as numbers."""
    numeric = features.withColumn("is_promo", F.col("is_promo").cast("int"))
    return complete_rows(numeric, list(inputs))


def tree_pipeline(inputs: Sequence[str] = INPUTS, **settings) -> Pipeline:
    """Gradient-boosted trees over the assembled inputs."""
    chosen = {**PLAIN_TREES, **settings}
    trees = GBTRegressor(
        featuresCol="features", labelCol=TARGET, predictionCol="prediction", **chosen
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(inputs), outputCol="features"), trees])


def feature_importance(model: PipelineModel, inputs: Sequence[str] = INPUTS) -> list[tuple]:
    """(feature, importance), most important first."""
    weights = model.stages[-1].featureImportances.toArray()
    return sorted(zip(inputs, map(float, weights)), key=lambda p: (-p[1], p[0]))


def non_negative(prediction: Column) -> Column:
    return F.greatest(prediction, F.lit(0.0))


def error_columns(prediction: str = "predicted_demand") -> list[Column]:
    error = F.col(TARGET) - F.col(prediction)
    return [
        error.alias("prediction_error"),
        (F.try_divide(error, F.col(TARGET).cast("double")) * 100).alias("prediction_error_pct"),
    ]


def score(
    model: PipelineModel, features: DataFrame, name: str, clip: bool = False
) -> DataFrame:
    """Batch scoring: prediction, error and provenance beside the feature columns."""
    rows = model_rows(features)
    predicted = F.col("prediction")
    if clip:
        predicted = non_negative(predicted)
    return (
        model.transform(rows)
        .select(*rows.columns, predicted.alias("predicted_demand"))
        .select(
            "*",
            *error_columns(),
            F.lit(name).alias("model_used"),
            F.current_timestamp().alias("predicted_at"),
        )
    )


def save_model(model: PipelineModel, path: str) -> None:
    """Store a fitted model in a folder, replacing what is there."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# -- seasonal regression -----------------------------------------------------


def seasonal_columns(weekly: int = 3, yearly: int = 10, time: str = "ds") -> dict[str, Column]:
    """Linear trend plus Fourier terms of the week and the year."""
    day = F.unix_date(F.col(time).cast("date")).cast("double")
    terms = {"trend": day / 365.25}
    for label, length, order in (("week", 7.0, weekly), ("year", 365.25, yearly)):
        for k in range(1, order + 1):
            angle = day * (2 * math.pi * k / length)
            terms[f"{label}_sin_{k}"] = F.sin(angle)
            terms[f"{label}_cos_{k}"] = F.cos(angle)
    return terms


def fit_seasonal(train: DataFrame, target: str = "actual", ridge: float = 1e-3) -> PipelineModel:
    """Regression on the log of demand plus one, so trend and seasons act as factors.

    Every day counts, those without demand too; returns beyond demand count as none.
    """
    terms = seasonal_columns()
    demand = F.greatest(F.col(target).cast("double"), F.lit(0.0))
    rows = train.select(
        F.log1p(demand).alias("log_demand"), *(c.alias(n) for n, c in terms.items())
    )
    stages = [
        VectorAssembler(inputCols=list(terms), outputCol="features"),
        LinearRegression(
            featuresCol="features", labelCol="log_demand", regParam=ridge, solver="normal"
        ),
    ]
    return Pipeline(stages=stages).fit(rows)


def predict_seasonal(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``pred`` to a frame with a ``ds`` column."""
    terms = seasonal_columns()
    scored = model.transform(df.withColumns(terms))
    return scored.select(*df.columns, non_negative(F.expm1("prediction")).alias("pred"))


# -- exponential smoothing ---------------------------------------------------

_LEVELS = np.array([0.1, 0.3, 0.6])
_TRENDS = np.array([0.01, 0.1])
_SEASONS = np.array([0.05, 0.2])


def smooth_series(
    history: np.ndarray,
    steps: np.ndarray,
    season: int = SEASON,
    weights: tuple[float, float, float] | None = None,
) -> tuple[np.ndarray, str]:
    """Additive Holt-Winters forecast of a dense daily series, and the method used.

    ``steps`` says how many days after the last one each forecast is for. Smoothing
    weights (level, trend, season) are chosen by least squared error unless given; all
    combinations are advanced together, one vector step per day. A series shorter than
    two seasons cannot show one: its forecast is its mean, and the method says so.
    """
    if len(history) < 2 * season:
        return np.full(len(steps), history.mean() if len(history) else 0.0), "mean"
    grid = ([w] for w in weights) if weights else (_LEVELS, _TRENDS, _SEASONS)
    alpha, beta, gamma = (g.ravel() for g in np.meshgrid(*grid, indexing="ij"))
    first, second = history[:season], history[season : 2 * season]
    level = np.full(alpha.shape, first.mean())
    trend = np.full(alpha.shape, (second.mean() - first.mean()) / season)
    seasonal = np.tile(first - first.mean(), (len(alpha), 1))
    squared = np.zeros(alpha.shape)
    for t in range(season, len(history)):
        slot = t % season
        expected = level + trend + seasonal[:, slot]
        surprise = history[t] - expected
        squared += surprise**2
        # Error-correction form of the three smoothing equations.
        level = level + trend + alpha * surprise
        trend = trend + alpha * beta * surprise
        seasonal[:, slot] += gamma * (1 - alpha) * surprise
    best = int(squared.argmin())
    slots = (len(history) - 1 + steps) % season
    return level[best] + trend[best] * steps + seasonal[best, slots], "holt_winters"


def forecast_series(
    daily: DataFrame,
    group: Sequence[str] = ("sku", "store_id"),
    season: int = SEASON,
    weights: tuple[float, float, float] | None = None,
) -> DataFrame:
    """Forecast the test rows of every series from its train rows.

    Input: ``ds``, ``actual``, ``is_test`` at daily grain, so one series is at most
    one row per day. A series is smoothed over the calendar: days without a row, between
    the first and the last train row, had no demand, and a forecast is for its date.
    Without a ``group`` the whole frame is one series. Output: the test rows with ``pred``
    and ``method``.
    """
    keys = list(group)
    schema = T.StructType(
        [daily.schema[k] for k in keys]
        + [
            daily.schema["ds"],
            T.StructField("actual", T.DoubleType()),
            T.StructField("pred", T.DoubleType()),
            T.StructField("method", T.StringType()),
        ]
    )

    def forecast(series: pd.DataFrame) -> pd.DataFrame:
        day = pd.to_datetime(series["ds"]).to_numpy().astype("datetime64[D]").astype(np.int64)
        test = series["is_test"].to_numpy(dtype=bool)
        history = np.zeros(0)
        last = day.min() - 1
        if (~test).any():
            known = day[~test]
            last = known.max()
            history = np.zeros(last - known.min() + 1)
            history[known - known.min()] = series.loc[~test, "actual"].to_numpy(dtype=float)
        pred, method = smooth_series(history, day[test] - last, season, weights)
        return series.loc[test, [*keys, "ds", "actual"]].assign(pred=pred, method=method)

    rows = daily.select(*keys, "ds", F.col("actual").cast("double").alias("actual"), "is_test")
    return rows.groupBy(*keys).applyInPandas(forecast, schema)
