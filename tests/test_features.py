import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import features, ranks, segments, staging


def series(spark, n=40, skus=("a", "b"), stores=(1, 2), seed=3):
    rng = random.Random(seed)
    start = dt.date(2023, 1, 1)
    rows = []
    for sku in skus:
        for store in stores:
            for i in range(n):
                units = rng.randint(0, 30)
                rows.append(
                    (sku, store, start + dt.timedelta(i), units, units + rng.randint(0, 3),
                     units * 2.5, rng.random() < 0.2, rng.random() < 0.1)
                )
    rng.shuffle(rows)
    return spark.createDataFrame(
        rows,
        "sku string, store_id int, ds date, units_sold bigint, demand bigint, revenue double,"
        " is_promo boolean, stockout_flag boolean",
    )


def test_features_match_brute_force(spark):
    daily = series(spark)
    pdf = daily.toPandas().sort_values(["sku", "store_id", "ds"])
    got = features.demand_features(daily).toPandas().set_index(["sku", "store_id", "ds"]).sort_index()
    for (sku, store), g in pdf.groupby(["sku", "store_id"]):
        y, days = g.units_sold.to_numpy(), g.ds.to_list()
        for i in range(7, len(y)):
            row = got.loc[(sku, store, days[i])]
            assert row.units_sold_lag_7 == y[i - 7]
            for n in (7, 14, 30):
                frame = y[max(0, i - n) : i]
                assert row[f"units_sold_roll_mean_{n}"] == pytest.approx(frame.mean())
                assert row[f"units_sold_roll_std_{n}"] == pytest.approx(frame.std(ddof=1))
                assert row[f"units_sold_roll_min_{n}"] == frame.min()
                assert row[f"units_sold_roll_max_{n}"] == frame.max()
            same_day = pdf[pdf.ds == days[i]]
            assert row.sku_total_qty == same_day[same_day.sku == sku].units_sold.sum()
            assert row.store_total_qty == same_day[same_day.store_id == store].units_sold.sum()
    assert len(got) == 4 * (40 - 7)


def test_first_seven_lags_are_unknown(spark):
    lagged = features.add_lag_features(series(spark, n=10))
    assert lagged.where("units_sold_lag_7 IS NULL").count() == 4 * 7


def test_lags_and_windows_share_one_shuffle(spark):
    daily = series(spark)
    columns = [
        *features.lag_columns(features.SERIES, "units_sold", (7, 14, 30)),
        *features.rolling_columns(features.SERIES, "units_sold", (7, 14, 30)),
    ]
    plan = daily.select("*", *columns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_weekend_is_saturday_and_sunday(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-05-06', date'2024-05-12')) AS ds")
    flags = features.add_calendar_features(days).orderBy("ds").select("is_weekend").collect()
    assert [r[0] for r in flags] == [0, 0, 0, 0, 0, 1, 1]


def test_daily_grain_sums_duplicates(spark):
    rows = [(dt.datetime(2024, 1, 1), 1, "a", 2, 3, 1.25, False, True)] * 3
    sales = spark.createDataFrame(
        rows,
        "date timestamp, store_id int, sku string, units_sold bigint, demand bigint,"
        " revenue double, is_promo boolean, stockout_flag boolean",
    )
    got = features.daily_grain(sales).collect()
    assert len(got) == 1
    assert (got[0].units_sold, got[0].demand, got[0].revenue) == (6, 9, 3.75)


@pytest.mark.parametrize("days, gaps", [((1, 2, 3), 0), ((1, 2, 5), 1)])
def test_date_gaps(spark, days, gaps):
    rows = [("a", 1, dt.date(2024, 1, d)) for d in days]
    df = spark.createDataFrame(rows, "sku string, store_id int, ds date")
    assert features.date_gaps(df).count() == gaps


def test_gap_filling_yields_the_dense_grid(spark):
    rows = [("a", 1, dt.date(2024, 1, d), u) for d, u in ((1, 5), (4, 6), (5, 7))]
    df = spark.createDataFrame(rows, "sku string, store_id int, ds date, units_sold bigint")
    got = [(r.ds.day, r.units_sold, r.is_filled) for r in features.fill_gaps(df).orderBy("ds").collect()]
    assert got == [(1, 5, False), (2, 0, True), (3, 0, True), (4, 6, False), (5, 7, False)]


def test_group_zscore_is_centred_and_zero_for_constants(spark):
    rows = [("a", float(i)) for i in range(20)] + [("b", 4.0)] * 5
    df = spark.createDataFrame(rows, "sku string, units_sold double")
    scored = features.group_zscore(df, "units_sold")
    means = {r.sku: r.m for r in scored.groupBy("sku").agg(F.avg("zscore").alias("m")).collect()}
    assert abs(means["a"]) < 1e-9 and means["b"] == 0


def test_week_over_week_needs_two_weeks(spark):
    def trend(n):
        rows = [(dt.date(2024, 1, 1) + dt.timedelta(i), 10.0 if i < 7 else 15.0) for i in range(n)]
        df = spark.createDataFrame(rows, "ds date, revenue double")
        return features.week_over_week(df).first().trend_pct

    assert trend(13) == 0.0
    assert trend(14) == pytest.approx(50.0)


# -- running totals and quantiles ---------------------------------------------


def test_running_totals_match_a_plain_window(spark):
    rng = random.Random(5)
    # One group holds most rows, so it must span several slices.
    rows = [("hot" if rng.random() < 0.9 else "cold", i, rng.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k int, v int").repartition(6)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = ranks.running_totals(df, ["k"], {"v": "v"}, within=["g"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    expected, totals = {}, {}
    for g, k, v in sorted(rows):
        totals[g] = totals.get(g, 0) + v
        expected[(g, k)] = totals[g]
    assert {(r.g, r.k): r.v_through for r in got} == expected
    assert {(r.g, r.v_total) for r in got} == set(totals.items())


def test_running_totals_descending_with_ties(spark):
    rows = [("b", 5), ("a", 5), ("c", 9)]
    df = spark.createDataFrame(rows, "sku string, n int")
    got = ranks.running_totals(df, [F.desc("n"), "sku"], {"n": "n"}).collect()
    assert {r.sku: r.n_through for r in got} == {"c": 9, "a": 14, "b": 19}


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_exact_quantiles_match_numpy(spark, n):
    rng = np.random.default_rng(n)
    x, y = rng.normal(size=n), rng.integers(0, 5, size=n).astype(float)
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "x double, y double")
    row = ranks.exact_quantiles(df, ["x", "y"], {"q1": 0.25, "p90": 0.9, "max": 1.0}).first()
    for name, values in (("x", x), ("y", y)):
        for suffix, p in (("q1", 0.25), ("p90", 0.9), ("max", 1.0)):
            assert row[f"{name}_{suffix}"] == pytest.approx(np.quantile(values, p))


def test_approximate_quantiles_are_close(spark):
    df = spark.range(10_000).select(F.col("id").cast("double").alias("x"))
    assert ranks.approx_quantiles(df, ["x"], {"q1": 0.25}).first().x_q1 == pytest.approx(2500, abs=5)


# -- segmentation ------------------------------------------------------------


def test_pareto_classes(spark):
    rows = [("a", 70), ("b", 20), ("c", 10)]
    df = spark.createDataFrame(rows, "sku string, total_volume bigint")
    got = {r.sku: (round(r.cumulative_pct, 6), r.abc_class) for r in segments.pareto(df).collect()}
    assert got == {"a": (0.7, "A"), "b": (0.9, "B"), "c": (1.0, "C")}


def test_single_observation_is_not_forecastable(spark):
    df = spark.createDataFrame([("a", 500)], "sku string, units_sold bigint")
    row = segments.segment(df, "sku").first()
    assert row.cv is None and row.forecastable is False


def test_filters(spark):
    rows = [(dt.date(2024, 1, d), d) for d in range(1, 11)]
    df = spark.createDataFrame(rows, "ds date, v int")
    assert staging.last_days(df, 3).count() == 4
    assert staging.between_dates(df, "2024-01-03", "2024-01-05").count() == 3
    assert staging.before_date(df, "2024-01-03").count() == 2
