import datetime as dt

import numpy as np
import pytest

from larder.operators import smoothing, trend
from larder.operators.models import smooth_series

START = dt.date(2020, 1, 1)


def planted(breaks, changes, days=1100, noise=2.0, seed=3):
    rng = np.random.default_rng(seed)
    t = np.arange(days)
    level = 100 + 0.1 * t + sum(c * np.maximum(t - b, 0) for b, c in zip(breaks, changes))
    season = 1 + 0.2 * np.sin(2 * np.pi * t / 7) + 0.1 * np.cos(2 * np.pi * t / 365.25)
    return level * season + rng.normal(0, noise, days)


def test_planted_breaks_are_found(spark):
    truth = {"a": ([300, 700], [-0.2, 0.3]), "b": ([500], [0.15]), "c": ([], [])}
    rows = [
        (k, START + dt.timedelta(i), float(v))
        for k, (b, c) in truth.items()
        for i, v in enumerate(planted(b, c))
    ]
    days = spark.createDataFrame([*rows, ("a", None, 1.0), ("d", START, None)], "k string, ds date, actual double")
    model = trend.fit_trend(days, ("k",))
    found = {r.k: [((b.day - START).days, b.change) for b in r.bends] for r in model.collect()}
    assert set(found) == set(truth)
    apart = 1100 * 0.8 / 25
    for k, (breaks, changes) in truth.items():
        for day, change in zip(breaks, changes):
            near = [c for d, c in found[k] if abs(d - day) <= 1.5 * apart]
            assert sum(near) == pytest.approx(change, abs=0.06), (k, found[k])
        far = [c for d, c in found[k] if all(abs(d - b) > 1.5 * apart for b in breaks)]
        assert all(abs(c) < 0.05 for c in far), (k, found[k])
    guess = trend.predict_trend(model, days.where("ds is not null and actual is not null"), ("k",)).toPandas()
    assert np.abs(guess.actual - guess.pred).mean() < 3


def test_later_days_follow_the_last_slope(spark):
    y = planted([], [], days=800, noise=0.5)
    days = spark.createDataFrame([(START + dt.timedelta(i), float(v)) for i, v in enumerate(y)], "ds date, actual double")
    known = days.where(f"ds < '{START + dt.timedelta(730)}'")
    model = trend.fit_trend(known)
    later = trend.predict_trend(model, days.where(f"ds >= '{START + dt.timedelta(730)}'")).toPandas()
    assert len(later) == 70
    assert np.abs(later.actual - later.pred).max() < 6
    assert trend.fit_trend(days.where("false")).count() == 0


def test_normal_equations(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(0)
    x = rng.normal(size=(90, 3))
    rows = [(i % 2, *map(float, r)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "k int, a double, b double, y double").repartition(6)
    found = trend.normal_equations(df, F.array("a", "b"), F.col("y"), ("k",)).collect()
    for r in found:
        mine = x[r.k :: 2]
        assert np.allclose(np.array(r.gram).reshape(3, 3), mine.T @ mine)


def test_path_keeps_what_is_there():
    rng = np.random.default_rng(1)
    place = np.linspace(0, 1, 500)
    settings = trend.Settings()
    hinges = [np.maximum(place - b, 0) for b in trend.candidate_places(settings)]
    x = np.stack([np.ones(500), place, *hinges], axis=1)
    y = 2 + place + 5 * hinges[10] - 8 * hinges[20] + rng.normal(0, 0.02, 500)
    whole = np.concatenate([x, y[:, None]], axis=1)
    beta = trend.solve_bends((whole.T @ whole).ravel(), 500, 2, settings)
    kept = set(np.flatnonzero(beta[2:]))
    assert {10, 20} <= kept and len(kept) <= 4
    assert np.abs(x @ beta - y).max() < 0.1


# -- smoothing ---------------------------------------------------------------


def grid_error(history, season=7):
    a, b, g = (v.ravel() for v in smoothing.GRID)
    first, second = history[:season], history[season : 2 * season]
    level = np.full(a.shape, first.mean())
    slope = np.full(a.shape, (second.mean() - first.mean()) / season)
    seasonal = np.tile(first - first.mean(), (len(a), 1))
    squared = np.zeros(a.shape)
    for t in range(season, len(history)):
        miss = history[t] - (level + slope + seasonal[:, t % season])
        squared += miss**2
        level = level + slope + a * miss
        slope = slope + a * b * miss
        seasonal[:, t % season] += g * (1 - a) * miss
    return squared.min()


def shapes(count=12, seed=2):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(14, 200, count)
    return [
        20 + rng.normal(0, 0.1) * np.arange(n) + 5 * np.sin(2 * np.pi * np.arange(n) / 7) + rng.normal(0, 2, n)
        for n in lengths
    ]


def test_fit_is_never_worse_than_the_grid():
    series = [*shapes(), np.zeros(30), np.full(14, 3.0)]
    lengths = np.array([len(s) for s in series])
    y = np.zeros((lengths.max(), len(series)))
    for i, s in enumerate(series):
        y[: len(s), i] = s
    weights, _, error = smoothing.fit(y, lengths)
    for i, s in enumerate(series):
        assert error[i] <= grid_error(s) + 1e-9
    assert ((weights >= smoothing.LEAST) & (weights <= smoothing.MOST)).all()
    assert np.mean([e / max(grid_error(s), 1e-9) for e, s in zip(error[:12], series)]) < 0.95


def test_recursion_equals_one_series_at_a_time():
    series = shapes(5)
    lengths = np.array([len(s) for s in series])
    y = np.zeros((lengths.max(), 5))
    for i, s in enumerate(series):
        y[: len(s), i] = s
    weights = np.tile(np.array([0.3, 0.1, 0.2])[:, None, None], (1, 5, 1))
    _, states = smoothing.smooth(y, lengths, weights, smoothing.first_states(y, 7))
    for i, s in enumerate(series):
        steps = np.arange(1, 15)
        want, _ = smooth_series(s, steps, weights=(0.3, 0.1, 0.2))
        slot = (len(s) - 1 + steps) % 7
        got = states.level[i, 0] + states.trend[i, 0] * steps + states.seasonal[slot, i, 0]
        assert np.allclose(got, want)


def test_forecasts_whatever_the_batches(spark, monkeypatch):
    rows = []
    for i, s in enumerate([*shapes(6), np.arange(5.0), np.zeros(0)]):
        rows += [(f"s{i}" if i else None, START + dt.timedelta(d), float(v), False) for d, v in enumerate(s) if d % 5 or d == 0]
        rows += [(f"s{i}" if i else None, START + dt.timedelta(len(s) + d), 1.0, True) for d in range(3)]
    daily = spark.createDataFrame(rows, "sku string, ds date, actual double, is_test boolean")
    got = smoothing.forecast_fitted(daily.repartition(3), ("sku",))
    assert got.count() == 8 * 3
    methods = {(r.sku, r.method) for r in got.select("sku", "method").distinct().collect()}
    assert methods == {(f"s{i}" if i else None, "holt_winters" if i < 6 else "mean") for i in range(8)}
    values = {(r.sku, r.ds): r.pred for r in got.collect()}
    assert values[("s6", START + dt.timedelta(5))] == pytest.approx(2.0)
    assert values[("s7", START)] == 0
    whole = smoothing.forecast_fitted(daily.where("sku = 's1'").drop("sku"), ())
    assert {r.ds: r.pred for r in whole.collect()} == pytest.approx(
        {d: p for (k, d), p in values.items() if k == "s1"}, rel=1e-6
    )
