import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import drift, metrics, models


def expected_metrics(y, p):
    e = np.abs(y - p)
    step = np.abs(np.diff(y)).mean()
    pos = y > 0
    size = np.abs(y) + np.abs(p)
    return {
        "mae": e.mean(),
        "rmse": math.sqrt((e**2).mean()),
        "wape": e.sum() / y.sum() * 100,
        "bias": (p.sum() - y.sum()) / y.sum() * 100,
        "mase": e.mean() / step,
        "hit_rate_20": (e[pos] / y[pos] <= 0.2).mean() * 100,
        "hit_rate_10": (e[pos] / y[pos] <= 0.1).mean() * 100,
        "smape": (2 * e[size > 0] / size[size > 0]).mean() * 100,
        "mape": (e[pos] / y[pos]).mean() * 100,
    }


@pytest.fixture(scope="module")
def predictions(spark):
    rng = np.random.default_rng(4)
    start = dt.date(2024, 1, 1)
    rows = [
        ("hot" if s < 8 else f"c{s}", s, start + dt.timedelta(d), float(rng.integers(0, 20)),
         float(rng.integers(0, 20)))
        for s in range(10)
        for d in range(30)
    ]
    schema = "sku string, store_id int, ds date, actual double, pred double"
    return spark.createDataFrame(rows, schema).repartition(5)


def test_group_metrics_match_numpy(predictions):
    got = {r.sku: r for r in metrics.evaluate_by(predictions, "sku").collect()}
    pdf = predictions.toPandas().sort_values(["ds", "store_id"])
    for sku, g in pdf.groupby("sku"):
        for name, value in expected_metrics(g.actual.to_numpy(), g.pred.to_numpy()).items():
            assert got[sku][name] == pytest.approx(value, abs=0.0501), (sku, name)


def test_daily_metrics_match_numpy(predictions):
    row = metrics.evaluate_daily(predictions).first()
    days = predictions.toPandas().groupby("ds")[["actual", "pred"]].sum()
    for name, value in expected_metrics(days.actual.to_numpy(), days.pred.to_numpy()).items():
        assert row[name] == pytest.approx(value, abs=0.0501), name


def test_small_groups_are_skipped(spark):
    rows = [("a", 1, dt.date(2024, 1, d), 1.0, 1.0) for d in range(1, 5)]
    df = spark.createDataFrame(rows, "sku string, store_id int, ds date, actual double, pred double")
    assert metrics.evaluate_by(df, "sku").count() == 0
    assert metrics.evaluate_by(df, "sku", min_rows=4).first().mase is None


def test_zero_demand_has_no_relative_metrics(spark):
    rows = [("a", 1, dt.date(2024, 1, d), 0.0, 0.0) for d in range(1, 8)]
    df = spark.createDataFrame(rows, "sku string, store_id int, ds date, actual double, pred double")
    row = metrics.evaluate_by(df, "sku").first()
    assert (row.mae, row.wape, row.hit_rate_20, row.smape, row.mape) == (0.0, None, None, None, None)


def test_best_model_ignores_total_only_models(spark):
    rows = [("x", "ML", 20.0, 60.0), ("y", "ML", 30.0, 70.0), ("ets", "TimeSeries", 1.0, 99.0)]
    table = spark.createDataFrame(rows, "model string, type string, wape double, hit_rate_20 double")
    assert metrics.best_model(table).first().model == "x"
    assert metrics.best_model(table, "hit_rate_20").first().model == "y"


def test_validation_gate(spark):
    rows = [("good", 10.0, 5.0), ("bad", 100.0, 5.0), ("none", None, None)]
    table = spark.createDataFrame(rows, "model string, rmse double, mape double")
    got = {r.model: (r.has_metrics, r.all_passed) for r in metrics.validation_gate(table).collect()}
    assert got == {"good": (True, True), "bad": (True, False), "none": (False, False)}


def test_time_split_is_ordered(feature_table):
    marked = models.mark_test_rows(feature_table)
    train = marked.where("NOT is_test").agg(F.max("ds")).first()[0]
    test = marked.where("is_test").agg(F.min("ds")).first()[0]
    assert train < test


def test_trees_score_batches(feature_table):
    rows = models.model_rows(feature_table)
    fitted = models.tree_pipeline(maxIter=3, maxDepth=3).fit(rows)
    scored = models.score(fitted, feature_table, "trees", clip=True)
    assert scored.count() == rows.count()
    assert scored.where("predicted_demand < 0").count() == 0
    worst = scored.agg(
        F.max(F.abs(F.col("units_sold") - F.col("predicted_demand") - F.col("prediction_error")))
    ).first()[0]
    assert worst < 1e-9
    weights = models.feature_importance(fitted)
    assert sum(w for _, w in weights) == pytest.approx(1.0)
    assert weights == sorted(weights, key=lambda p: (-p[1], p[0]))


def test_smoothing_follows_trend_and_season():
    t = np.arange(140)
    season = np.array([0, 3, 6, 2, -4, -5, -2.0])
    y = 50 + 0.3 * t + season[t % 7]
    forecast, method = models.smooth_series(y[:112], np.arange(1, 29))
    assert np.abs(forecast - y[112:]).max() < 1.5 and method == "holt_winters"
    for history, mean in (([4.0, 6.0], 5.0), ([], 0.0)):
        forecast, method = models.smooth_series(np.array(history), np.arange(1, 4))
        assert (forecast == mean).all() and method == "mean"


def test_series_with_gaps_keep_their_week(spark):
    """Sales on two days a week only: the season is a matter of the date, not of the row."""
    start = dt.date(2024, 1, 1)
    rows = [
        ("a", start + dt.timedelta(d), 20 if d % 7 == 2 else 10, d >= 84)
        for d in range(112)
        if d % 7 in (2, 5) and d % 35 != 5
    ]
    df = spark.createDataFrame(rows, "sku string, ds date, actual int, is_test boolean")
    got = {r.ds: r for r in models.forecast_series(df, ["sku"]).collect()}
    assert len(got) == sum(r[3] for r in rows)
    assert all(abs(got[r[1]].pred - r[2]) < 4 for r in rows if r[3])
    assert {r.method for r in got.values()} == {"holt_winters"}
    whole = models.forecast_series(df.drop("sku"), []).collect()
    assert sorted(r.pred for r in whole) == sorted(r.pred for r in got.values())


def test_series_forecasts_cover_the_test_rows(spark):
    rows = [
        (s, 1, dt.date(2024, 1, 1) + dt.timedelta(d), 10 + d % 7, d >= 40)
        for s in ("a", "b")
        for d in range(50)
    ]
    df = spark.createDataFrame(rows, "sku string, store_id int, ds date, actual int, is_test boolean")
    got = models.forecast_series(df).collect()
    assert len(got) == 20
    assert max(abs(r.pred - r.actual) for r in got) < 2.0


def test_seasonal_regression_learns_the_week(spark):
    rows = [
        (dt.date(2022, 1, 1) + dt.timedelta(d), 100.0 * (1 + 0.3 * math.sin(2 * math.pi * d / 7)))
        for d in range(730)
    ]
    df = spark.createDataFrame(rows, "ds date, actual double")
    fitted = models.fit_seasonal(df.where("ds < '2023-06-01'"))
    got = models.predict_seasonal(fitted, df.where("ds >= '2023-06-01'")).collect()
    assert max(abs(r.pred - r.actual) / r.actual for r in got) < 0.05


# -- drift -----------------------------------------------------------------------


def marked(spark, reference, current):
    rows = [(float(v), True, False) for v in reference] + [(float(v), False, True) for v in current]
    return spark.createDataFrame(rows, "x double, is_reference boolean, is_current boolean")


def expected_psi(reference, current, bins=10):
    edges = np.histogram_bin_edges(reference, bins)
    r = (np.histogram(reference, edges)[0] + 1) / (len(reference) + bins)
    c = (np.histogram(current, edges)[0] + 1) / (len(current) + bins)
    return ((c - r) * np.log(c / r)).sum()


def expected_ks(a, b):
    grid = np.unique(np.concatenate([a, b]))
    f = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    g = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    return np.abs(f - g).max()


@pytest.mark.parametrize("shift", [0.0, 0.3, 8.0])
def test_psi_and_ks_match_numpy(spark, shift):
    rng = np.random.default_rng(7)
    a, b = rng.normal(size=400).round(3), (rng.normal(size=250) + shift).round(3)
    rows = marked(spark, a, b)
    ranked = drift.ranked_histogram(rows, ["x"])
    assert drift.psi(rows, ["x"]).first().psi == pytest.approx(expected_psi(a, b))
    assert drift.ks_statistic(ranked).first().ks_statistic == pytest.approx(expected_ks(a, b))


def test_psi_of_a_constant_feature(spark):
    a, b = np.full(50, 3.0), np.full(20, 3.0)
    got = drift.psi(marked(spark, a, b), ["x"]).first().psi
    assert got == pytest.approx(expected_psi(a, b))
    assert got >= 0


def test_p_value_series_agree_and_fall(spark):
    xs = [0.01, 0.3, 0.6, 0.99, 1.01, 1.36, 2.0, 4.0]
    n = 10_000
    df = spark.createDataFrame([(x / math.sqrt(n / 2),) for x in xs], "d double")
    got = [r.p for r in df.select(
        drift.asymptotic_p_value(F.col("d"), F.lit(n), F.lit(n)).alias("p")).collect()]
    direct = [
        min(1.0, max(0.0, sum(2 * (-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 2000))))
        if x > 0.05 else 1.0
        for x in xs
    ]
    assert got == pytest.approx(direct, abs=1e-9)
    assert got == sorted(got, reverse=True)


def test_drift_status(spark):
    df = spark.createDataFrame([(0.05,), (0.15,), (0.25,)], "psi double")
    got = [r.s for r in df.select(drift.drift_status(F.col("psi")).alias("s")).collect()]
    assert got == ["green", "yellow", "red"]


def test_retrain_threshold_is_honoured(spark):
    rows = [("a", True), ("b", False), ("c", False), ("units_sold", True)]
    report = spark.createDataFrame(rows, "feature string, drift_detected boolean")
    assert drift.dataset_drift(report).first().drift_share == pytest.approx(0.3333)
    assert drift.retrain_decision(report).first().action == "retrain"
    assert drift.retrain_decision(report, limit=0.5).first().action == "skip"
