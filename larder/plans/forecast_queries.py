"""Segmentation, accuracy and model queries."""

from __future__ import annotations

import math
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import round_to
from larder.operators import (
    anomalies,
    boosting,
    features,
    metrics,
    models,
    segments,
    smoothing,
    trend,
)
from larder.plans.registry import CANDIDATES, KINDS, isum, pct, query, r
from larder.plans.views import accuracy
from larder.session import fresh_path, side_by_side, stage

PROFILE = ("mean_demand", "std_demand", "cv", "nonzero_pct", "cumulative_pct")


def _profile_sql(*columns: str) -> str:
    return ", ".join(f"{r(c, 4)} AS {c}" for c in columns)


def _rounded(df):
    return df.withColumns({c: round_to(c, 4) for c in PROFILE if c in df.columns})


@query(
    "product_segments", "M10 W6 W7", f"SELECT * REPLACE ({_profile_sql(*PROFILE)}) FROM part_segments"
)
def _(w):
    return _rounded(segments.pareto(segments.segment(w.line, "sku")))


@query(
    "brand_segments", "M10 W6 W7", f"SELECT * REPLACE ({_profile_sql(*PROFILE)}) FROM sku_segments"
)
def _(w):
    return _rounded(w.sku_segments)


@query(
    "store_segments", "M11", f"SELECT * REPLACE ({_profile_sql(*PROFILE[:4])}) FROM store_segments"
)
def _(w):
    return _rounded(segments.segment_stores(w.features))


@query(
    "segment_counts",
    "M27",
    f"""SELECT 'sku' AS entity, COUNT(*) AS total, COUNT(*) FILTER (WHERE forecastable) AS forecastable,
      {pct("COUNT(*) FILTER (WHERE forecastable)", "COUNT(*)")} AS pct FROM sku_profile
    UNION ALL SELECT 'store_id', COUNT(*), COUNT(*) FILTER (WHERE forecastable),
      {pct("COUNT(*) FILTER (WHERE forecastable)", "COUNT(*)")} FROM store_segments""",
)
def _(w):
    table = w.sold
    return segments.segment_counts(
        segments.segment(table, "sku"), segments.segment_stores(table)
    )


@query(
    "class_counts", "M27 W7", "SELECT abc_class, COUNT(*) AS skus FROM part_segments GROUP BY abc_class"
)
def _(w):
    return segments.class_counts(segments.pareto(segments.segment(w.line, "sku")))


@query(
    "volume_coverage",
    "M23",
    f"""SELECT {isum("CASE WHEN forecastable THEN total_volume ELSE 0 END")} AS forecastable_volume,
      {isum("total_volume")} AS total_volume,
      {pct("SUM(CASE WHEN forecastable THEN total_volume ELSE 0 END)", "SUM(total_volume)")}
        AS coverage_pct FROM part_profile""",
)
def _(w):
    return segments.volume_coverage(segments.segment(w.line, "sku"))


@query(
    "time_split",
    "M12",
    f"""SELECT is_test, COUNT(*) AS rows, MIN(ds) AS first_day, MAX(ds) AS last_day,
      {isum("units_sold")} AS units FROM split_features GROUP BY is_test""",
)
def _(w):
    split = models.mark_test_rows(w.sold)
    return split.groupBy("is_test").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("ds").alias("first_day"),
        F.max("ds").alias("last_day"),
        F.sum("units_sold").alias("units"),
    )


@query(
    "row_accuracy",
    "M1 M2 M3 M4 M5 M6 M7",
    f"SELECT * FROM ({accuracy('predictions', 'model', 'ds, sku, store_id')})",
)
def _(w):
    return metrics.evaluate(w.test_rows, ["model"], ("ds", "sku", "store_id"))


@query(
    "daily_accuracy",
    "M9 W8",
    f"SELECT * FROM ({accuracy('daily_predictions', 'model', 'ds')})",
)
def _(w):
    return metrics.evaluate_daily(w.test_rows, ["model"])


FORECASTABLE_DAYS = """(SELECT model, ds, SUM(actual) AS actual, SUM(pred) AS pred FROM predictions
  WHERE sku IN (SELECT sku FROM sku_profile WHERE forecastable) GROUP BY model, ds)"""


@query(
    "daily_accuracy_forecastable",
    "M9 J8",
    f"SELECT * FROM ({accuracy(FORECASTABLE_DAYS, 'model', 'ds')})",
)
def _(w):
    chosen = segments.segment(w.candidates, "sku")
    return metrics.evaluate_daily(segments.forecastable_rows(w.test_rows, chosen), ["model"])


@query("accuracy_by_sku", "M8 J11", "SELECT * FROM metrics_by_sku")
def _(w):
    return metrics.evaluate_by(w.test_rows, "sku", w.sku_segments, by=["model"])


@query(
    "accuracy_by_store",
    "M8 J11",
    f"""SELECT m.*, forecastable, {r("cv", 2)} AS cv
    FROM ({accuracy("predictions", "model, store_id", "ds, sku")}) m
    LEFT JOIN store_segments s ON m.store_id = s.store_id WHERE n_records >= 5""",
)
def _(w):
    stores = segments.segment_stores(w.candidates)
    return metrics.evaluate_by(w.test_rows, "store_id", stores, by=["model"])


@query("model_comparison", "M21", "SELECT * FROM comparison ORDER BY wape, model")
def _(w):
    return metrics.compare_models(w.test_rows, KINDS)


@query(
    "best_model",
    "M20 T4",
    "SELECT * FROM comparison WHERE type = 'ML' ORDER BY wape, model LIMIT 1",
)
def _(w):
    return metrics.best_model(metrics.compare_models(w.test_rows, KINDS))


@query(
    "best_model_by_hits",
    "M20 T4",
    "SELECT * FROM comparison WHERE type = 'ML' ORDER BY hit_rate_20 DESC, model LIMIT 1",
)
def _(w):
    return metrics.best_model(metrics.compare_models(w.test_rows, KINDS), "hit_rate_20")


@query(
    "validation_gate",
    "M22",
    f"""SELECT model, rmse IS NOT NULL OR mape IS NOT NULL AS has_metrics,
      rmse < 100 AS rmse_threshold, mape < 50 AS mape_threshold,
      (rmse IS NOT NULL OR mape IS NOT NULL) AND rmse < 100 AND mape < 50 AS all_passed
    FROM ({accuracy('daily_predictions', 'model', 'ds')})""",
)
def _(w):
    return metrics.validation_gate(metrics.evaluate_daily(w.test_rows, ["model"]))


@query(
    "median_by_class",
    "M24",
    f"""SELECT model, abc_class, COUNT(*) AS n, {r("MEDIAN(wape)", 4)} AS median_wape,
      {r("MEDIAN(bias)", 4)} AS median_bias, SUM(total_actual) AS total_actual
    FROM metrics_by_sku GROUP BY model, abc_class""",
)
def _(w):
    measured = metrics.evaluate_by(w.test_rows, "sku", w.sku_segments, by=["model"])
    return metrics.median_by_segment(measured, "abc_class", ["model"])


@query(
    "highest_impact",
    "M25 T3",
    """SELECT model, sku, wape, bias, total_actual, wape * total_actual AS impact FROM metrics_by_sku
    WHERE forecastable
    QUALIFY row_number() OVER (PARTITION BY model ORDER BY wape * total_actual DESC, sku) <= 5""",
)
def _(w):
    measured = metrics.evaluate_by(w.test_rows, "sku", w.sku_segments, by=["model"])
    return metrics.highest_impact(measured, by=["model"])


@query(
    "prediction_stats",
    "M19 M26",
    f"""SELECT {r("SUM(ABS(units_sold - p)) / SUM(units_sold) * 100", 2)} AS wape,
      {r("(SUM(p) - SUM(units_sold)) / SUM(units_sold) * 100", 2)} AS bias
    FROM (SELECT units_sold, GREATEST(2 * units_sold_roll_mean_7 - units_sold_lag_7, 0) AS p
      FROM features)""",
)
def _(w):
    guess = 2 * F.col("units_sold_roll_mean_7") - F.col("units_sold_lag_7")
    scored = w.features.withColumn("predicted_demand", models.non_negative(guess))
    return metrics.prediction_stats(scored)


@query(
    "prediction_errors",
    "M18",
    f"""SELECT ds, sku, store_id, {r("p", 4)} AS predicted_demand,
      {r("units_sold - p", 4)} AS prediction_error,
      {r("(units_sold - p) / NULLIF(units_sold, 0) * 100", 4)} AS prediction_error_pct
    FROM (SELECT *, GREATEST(2 * units_sold_roll_mean_7 - units_sold_lag_7, 0) AS p FROM features)""",
)
def _(w):
    guess = 2 * F.col("units_sold_roll_mean_7") - F.col("units_sold_lag_7")
    scored = w.features.withColumn("predicted_demand", models.non_negative(guess)).select(
        "ds", "sku", "store_id", "predicted_demand", *models.error_columns()
    )
    return scored.withColumns(
        {
            c: round_to(c, 4)
            for c in ("predicted_demand", "prediction_error", "prediction_error_pct")
        }
    )


# -- trained models (no SQL counterpart) -------------------------------------


def _split(w):
    rows = w.stored(*features.SERIES, "ds", models.TARGET, *models.INPUTS)
    marked = models.mark_test_rows(models.model_rows(rows))
    return stage(marked, "model_rows")


def _as_predictions(scored, name: str):
    return scored.select(
        F.lit(name).alias("model"),
        "ds",
        "sku",
        "store_id",
        F.col("units_sold").cast("double").alias("actual"),
        F.col("predicted_demand").alias("pred"),
    )


def _tree_accuracy(w, name: str, settings: dict):
    rows = _split(w)
    fitted = models.tree_pipeline(**settings).fit(rows.where("NOT is_test"))
    scored = models.score(fitted, rows.where("is_test"), name, clip=True)
    return metrics.compare_models(_as_predictions(scored, name), {name: "ML"})


@query("boosted_trees", "M13 M18")
def _(w):
    return _tree_accuracy(w, "boosted_trees", models.PLAIN_TREES)


@query("sampled_boosted_trees", "M14 M18")
def _(w):
    return _tree_accuracy(w, "sampled_boosted_trees", models.SAMPLED_TREES)


@query("feature_importance", "M15")
def _(w):
    rows = _split(w)
    fitted = models.tree_pipeline().fit(rows.where("NOT is_test"))
    return w.spark.createDataFrame(
        models.feature_importance(fitted), "feature string, importance double"
    )


# As many rounds as the trees it is compared with; the comparison of all models has the full 200.
SAME_ROUNDS = boosting.Settings(rounds=models.PLAIN_TREES["maxIter"])


@query("histogram_boosting", "M14 M18")
def _(w):
    rows = _split(w)
    fitted = boosting.fit_booster(rows.where("NOT is_test"), settings=SAME_ROUNDS)
    scored = boosting.score(fitted, rows.where("is_test"), "histogram_boosting", clip=True)
    return metrics.compare_models(_as_predictions(scored, "histogram_boosting"), {"histogram_boosting": "ML"})


def _days(w):
    """Units per day, marked by period."""
    marked = models.mark_test_rows(w.sold)
    return stage(
        marked.groupBy("ds", "is_test").agg(F.sum("units_sold").cast("double").alias("actual")),
        "days",
    )


def _seasonal_predictions(days):
    fitted = models.fit_seasonal(days.where("NOT is_test"))
    return models.predict_seasonal(fitted, days.where("is_test"))


def _smoothed_series(w):
    """Forecasts of every calendar day: a day without sales is one without demand, and is
    measured as one, so that models are not judged on the days that happened to have sales."""
    first = models.mark_test_rows(w.sold).where("is_test").agg(F.min("ds").alias("first_test"))
    days = features.fill_gaps(
        w.sold.select(*features.SERIES, "ds", F.col("units_sold").alias("actual"))
    )
    rows = anomalies.attach(days, first).withColumn("is_test", F.col("ds") >= F.col("first_test"))
    return stage(smoothing.forecast_fitted(rows), "smoothed")


@query("seasonal_regression", "M17")
def _(w):
    return metrics.compare_models(
        _seasonal_predictions(_days(w)).withColumn("model", F.lit("seasonal_regression")),
        {"seasonal_regression": "TimeSeries"},
    )


@query("series_smoothing", "M16")
def _(w):
    return metrics.compare_models(
        _smoothed_series(w).withColumn("model", F.lit("series_smoothing")),
        {"series_smoothing": "TimeSeries"},
    )


ALPHA, BETA, GAMMA = 0.3, 0.1, 0.2


@query(
    "daily_smoothing",
    "M16",
    f"""SELECT ds, actual, {r("level + trend * step + seasonal[(n - 1 + step) % 7 + 1]", 4)} AS pred
    FROM (WITH RECURSIVE
      totals AS MATERIALIZED (SELECT ds, is_test, CAST(SUM(units_sold) AS DOUBLE) AS actual
        FROM split_features GROUP BY ds, is_test),
      span AS MATERIALIZED (SELECT MIN(ds) AS first, MAX(ds) AS last FROM totals WHERE NOT is_test),
      history AS MATERIALIZED (SELECT date_diff('day', first, CAST(day AS DATE)) AS t,
          COALESCE(actual, 0) AS actual
        FROM (SELECT first, UNNEST(generate_series(first, last, INTERVAL 1 DAY)) AS day FROM span)
        LEFT JOIN (SELECT * FROM totals WHERE NOT is_test) d ON d.ds = CAST(day AS DATE)),
      start AS (SELECT AVG(actual) FILTER (WHERE t < 7) AS a, AVG(actual) FILTER (WHERE t >= 7) AS b,
          LIST(actual ORDER BY t) FILTER (WHERE t < 7) AS week FROM history WHERE t < 14),
      run AS (
        SELECT 6::BIGINT AS t, a AS level, (b - a) / 7 AS trend,
          list_transform(week, lambda x: x - a) AS seasonal FROM start
        UNION ALL
        SELECT h.t, level + trend + {ALPHA} * s, trend + {ALPHA * BETA} * s,
          list_transform(seasonal, lambda x, i:
            CASE WHEN i = h.t % 7 + 1 THEN x + {GAMMA * (1 - ALPHA)} * s ELSE x END)
        FROM (SELECT h.t, level, trend, seasonal,
            h.actual - (level + trend + seasonal[h.t % 7 + 1]) AS s
          FROM run JOIN history h ON h.t = run.t + 1) h)
      SELECT d.ds, d.actual, level, trend, seasonal, run.t + 1 AS n,
        date_diff('day', last, d.ds) AS step
      FROM totals d, span, run
      WHERE d.is_test AND run.t = (SELECT MAX(t) FROM history))""",
)
def _(w):
    # The daily total as one series, with fixed weights, so that SQL can follow.
    forecast = models.forecast_series(_days(w), group=(), weights=(ALPHA, BETA, GAMMA))
    return forecast.select("ds", "actual", round_to("pred", 4).alias("pred"))


@query(
    "smoothing_methods",
    "M16",
    """SELECT CASE WHEN cut - first >= 14 THEN 'holt_winters' ELSE 'mean' END AS method,
      CAST(SUM(last - GREATEST(first, cut) + 1) AS BIGINT) AS rows, CAST(SUM(units) AS DOUBLE) AS actual,
      TRUE AS all_known
    FROM (SELECT sku, store_id, MIN(ds) AS first, MAX(ds) AS last,
        SUM(units_sold) FILTER (WHERE is_test) AS units FROM split_features GROUP BY sku, store_id),
      (SELECT MIN(ds) AS cut FROM split_features WHERE is_test)
    WHERE last >= cut GROUP BY 1""",
)
def _(w):
    # Which series are long enough to be fitted; their forecasts are beyond SQL.
    return _smoothed_series(w).groupBy("method").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("actual").alias("actual"),
        F.bool_and(F.col("pred").isNotNull() & ~F.isnan("pred")).alias("all_known"),
    )


@query("trend_regression", "M17")
def _(w):
    days = _days(w)
    fitted = trend.fit_trend(days.where("NOT is_test"))
    predicted = trend.predict_trend(fitted, days.where("is_test"))
    return metrics.compare_models(
        predicted.withColumn("model", F.lit("trend_regression")), {"trend_regression": "TimeSeries"}
    )


@query("trend_bends", "M17")
def _(w):
    """Change points of the daily total, with the change of slope per day."""
    fitted = trend.fit_trend(_days(w).where("NOT is_test"))
    return fitted.select(F.inline("bends")).select("day", round_to("change", 6).alias("change"))


BENDS = (0.25, 0.5, 0.75)
_WEEK = f"date_diff('day', DATE '1970-01-01', ds) * {2 * math.pi / 7!r}"
_TERMS = [
    "1.0",
    "place",
    *(f"GREATEST(place - {b}, 0)" for b in BENDS),
    f"SIN({_WEEK})",
    f"COS({_WEEK})",
    "actual / 1000",
]


@query(
    "trend_equations",
    "M17",
    "SELECT * FROM (WITH days AS MATERIALIZED (SELECT *, date_diff('day', MIN(ds) OVER (), ds) / CAST(date_diff('day',"
    " MIN(ds) OVER (), MAX(ds) OVER ()) AS DOUBLE) AS place FROM (SELECT ds, CAST(SUM(units_sold) AS DOUBLE)"
    " AS actual FROM split_features WHERE NOT is_test GROUP BY ds)) "
    + " UNION ALL ".join(
        f"""SELECT {i} AS "row", {j} AS "column", {r(f"SUM(CAST({a} AS DOUBLE) * CAST({b} AS DOUBLE))", 4)}
          AS total FROM days"""
        for i, a in enumerate(_TERMS)
        for j, b in enumerate(_TERMS)
    )
    + ")",
)
def _(w):
    # The normal equations of a small trend with weekly season, the last row being the target.
    days = _days(w).where("NOT is_test")
    rows = trend.placed(days, trend.history_spans(days, (), "actual"), ())
    week = trend.season_terms(trend.Settings(weekly=1, yearly=0))
    terms = F.concat(trend.trend_terms(BENDS), week)
    gram = trend.normal_equations(rows, terms, F.col("actual") / 1000)
    side = len(BENDS) + 5
    return gram.select(F.posexplode("gram").alias("cell", "total")).select(
        F.floor(F.col("cell") / side).cast("int").alias("row"),
        (F.col("cell") % side).cast("int").alias("column"),
        round_to("total", 4).alias("total"),
    )


COMPLETE_INPUTS = " AND ".join(f"{c} IS NOT NULL" for c in models.INPUTS)
SCORED = f"""(SELECT *, date_diff('day', DATE '1970-01-01', ds) AS day FROM features
      WHERE {COMPLETE_INPUTS})
    WHERE day >= (SELECT QUANTILE_CONT(date_diff('day', DATE '1970-01-01', ds), 0.8)
      FROM features WHERE {COMPLETE_INPUTS})"""


def _tree_facts(scored, name: str, trees: int, importance: float):
    """What SQL can check of a fitted model: its size, what it scored, and that shares add up."""
    return scored.agg(
        F.lit(name).alias("model"),
        F.lit(trees).alias("trees"),
        F.count(F.lit(1)).alias("rows_scored"),
        F.sum("units_sold").alias("units_sold"),
        F.bool_and(F.col("predicted_demand") >= 0).alias("non_negative"),
        F.lit(round(importance, 6)).alias("importance"),
    )


def _facts_sql(name: str, trees: int) -> str:
    return f"""SELECT '{name}' AS model, {trees} AS trees, COUNT(*) AS rows_scored,
      {isum("units_sold")} AS units_sold, TRUE AS non_negative, CAST(1 AS DOUBLE) AS importance
    FROM {SCORED}"""


@query(
    "boosted_tree_facts", "M13 M15 M18", _facts_sql("boosted_trees", models.PLAIN_TREES["maxIter"])
)
def _(w):
    rows = _split(w)
    fitted = models.tree_pipeline().fit(rows.where("NOT is_test"))
    scored = models.score(fitted, rows.where("is_test"), "boosted_trees", clip=True)
    shares = sum(share for _, share in models.feature_importance(fitted))
    return _tree_facts(scored, "boosted_trees", fitted.stages[-1].getNumTrees, shares)


@query(
    "histogram_boosting_facts",
    "M14 M15 M18",
    f"""SELECT *, TRUE AS a_job_per_level
    FROM ({_facts_sql("histogram_boosting", SAME_ROUNDS.rounds)})""",
)
def _(w):
    rows = _split(w)
    fitted = boosting.fit_booster(rows.where("NOT is_test"), settings=SAME_ROUNDS)
    scored = boosting.score(fitted, rows.where("is_test"), "histogram_boosting", clip=True)
    shares = sum(share for _, share in fitted.importance())
    facts = _tree_facts(scored, "histogram_boosting", len(fitted.trees), shares)
    return facts.withColumn("a_job_per_level", F.lit(max(fitted.jobs) <= fitted.depth))


ERRORS = ("prediction_error", "prediction_error_pct")
TRAINED_KINDS = {
    "boosted_trees": "ML",
    "sampled_boosted_trees": "ML",
    "histogram_boosting": "ML",
    "seasonal_regression": "TimeSeries",
    "trend_regression": "TimeSeries",
    "series_smoothing": "TimeSeries",
}


def _trained_predictions(w):
    """Predictions of every trained model for the days of the test period.

    The fits do not need each other and are made side by side: a boosted tree is a short job
    per level, so one fit leaves most of the cluster idle.
    """
    rows, days = side_by_side(w.spark, [partial(_split, w), partial(_days, w)])
    train, test = rows.where("NOT is_test"), rows.where("is_test")
    columns = ("model", "ds", "sku", "actual", "pred")

    def trees(name, settings):
        fitted = models.tree_pipeline(**settings).fit(train)
        return _as_predictions(models.score(fitted, test, name, clip=True), name).select(*columns)

    def histogram():
        name = "histogram_boosting"
        scored = boosting.score(boosting.fit_booster(train), test, name, clip=True)
        return _as_predictions(scored, name).select(*columns)

    def total(name, predicted):
        return predicted.select(F.lit(name).alias("model"), "ds", F.lit(None).alias("sku"), "actual", "pred")

    def seasonal():
        return total("seasonal_regression", _seasonal_predictions(days))

    def bent():
        fitted = trend.fit_trend(days.where("NOT is_test"))
        return total("trend_regression", trend.predict_trend(fitted, days.where("is_test")))

    def smoothed():
        return _smoothed_series(w).withColumn("model", F.lit("series_smoothing")).select(*columns)

    fits = [
        partial(trees, "boosted_trees", models.PLAIN_TREES),
        partial(trees, "sampled_boosted_trees", models.SAMPLED_TREES),
        histogram,
        seasonal,
        bent,
        smoothed,
    ]
    return stage(reduce(DataFrame.union, side_by_side(w.spark, fits)), "predictions")


@query("trained_comparison", "M13 M14 M16 M17 M20 M21 M22")
def _(w):
    """All trained models side by side, the best of the tree models marked, and the gate."""
    predictions = _trained_predictions(w)
    compared = stage(metrics.compare_models(predictions, TRAINED_KINDS), "compared")
    best = metrics.best_model(compared).select("model", F.lit(True).alias("is_best"))
    gate = metrics.validation_gate(metrics.evaluate_daily(predictions, ["model"]))
    return (
        compared.join(best, "model", "left")
        .fillna(False, ["is_best"])
        .join(gate.select("model", "all_passed"), "model")
    )


@query("saved_model_scores", "M18")
def _(w):
    """A model is fitted, saved, loaded and then scores a table."""
    rows = _split(w)
    path = fresh_path(w.spark, "model")
    models.save_model(models.tree_pipeline().fit(rows.where("NOT is_test")), path)
    scored = models.score(models.load_model(path), rows.where("is_test"), "boosted_trees", clip=True)
    return scored.select(
        "ds", "sku", "store_id", "units_sold", "predicted_demand", *ERRORS, "model_used"
    )
