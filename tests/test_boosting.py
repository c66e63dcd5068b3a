"""Histogram boosting against a plain booster in memory."""

import threading

import numpy as np
import pytest

from larder.operators import boosting, models
from larder.plans import forecast_queries

INPUTS = ("a", "b", "c")
SETTINGS = boosting.Settings(rounds=6, depth=3, bins=16, rows=1.0, columns=1.0, rate=0.3)


def table(spark, n=2000, seed=5, parts=4):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 12, n), rng.normal(size=n).round(2), rng.integers(0, 3, n)], axis=1).astype(float)
    y = 10 * (x[:, 0] > 5) + 4 * x[:, 1] * (x[:, 2] == 1) + rng.normal(size=n).round(3)
    rows = [(int(i), *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id bigint, a double, b double, c double, y double").repartition(parts), x, y


def plain_booster(x, y, edges, s):
    """Exact greedy boosting over the same bins, node by node."""
    bins = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], axis=1)
    pred = np.full(len(y), y.mean())
    for _ in range(s.rounds):
        step = np.zeros(len(y))
        nodes = [np.arange(len(y))]
        for _ in range(s.depth):
            children = []
            for rows in nodes:
                g, h = (pred - y)[rows], len(rows)
                best = (1e-12, None)
                for f in range(x.shape[1]):
                    for cut in range(s.bins):
                        left = bins[rows, f] <= cut
                        n = left.sum()
                        if min(n, h - n) < s.least_hessian:
                            continue
                        gl = g[left].sum()
                        gain = gl**2 / (n + s.l2) + (g.sum() - gl) ** 2 / (h - n + s.l2) - g.sum() ** 2 / (h + s.l2)
                        if gain > best[0] + 1e-9:
                            best = (gain, left)
                if best[1] is not None:
                    for part in (rows[best[1]], rows[~best[1]]):
                        step[part] = -s.rate * (pred - y)[part].sum() / (len(part) + s.l2)
                        children.append(part)
            nodes = children
        pred = pred + step
    return pred


def predicted(booster, df):
    return {r.id: r.predicted_demand for r in boosting.predict(booster, df).collect()}


def test_equals_plain_booster(spark):
    df, x, y = table(spark)
    booster = boosting.fit_booster(df, INPUTS, "y", ("id",), SETTINGS)
    want = plain_booster(x, y, booster.edges, SETTINGS)
    got = predicted(booster, df)
    assert np.allclose([got[i] for i in range(len(y))], want, atol=1e-6)
    assert max(booster.jobs) <= SETTINGS.depth and len(booster.trees) == SETTINGS.rounds
    assert sum(share for _, share in booster.importance()) == pytest.approx(1)


def test_same_seed_same_predictions_however_rows_are_spread(spark, monkeypatch):
    settings = boosting.Settings(rounds=25, depth=3, bins=16)  # stores its state on the way
    results = []
    for parts, direct in ((1, 32), (7, 0)):  # sums straight to the driver, and through a shuffle
        monkeypatch.setattr(boosting, "DIRECT", direct)
        df, _, _ = table(spark, n=600, parts=parts)
        booster = boosting.fit_booster(df, INPUTS, "y", ("id",), settings)
        results.append(predicted(booster, df))
    assert results[0] == results[1]
    other = boosting.Settings(rounds=25, depth=3, bins=16, seed=7)
    df, _, _ = table(spark, n=600)
    assert predicted(boosting.fit_booster(df, INPUTS, "y", ("id",), other), df) != results[0]


def test_a_job_sums_only_the_smaller_child_of_a_split(spark, monkeypatch):
    sums, rows = boosting.histograms, []

    def counted(state, booster, tree, number, level, columns, wanted, *rest):
        found = sums(state, booster, tree, number, level, columns, wanted, *rest)
        everything = sums(state, booster, tree, number, level, columns, np.ones_like(wanted), *rest)
        counts = everything[1][:, 0].sum(axis=1)
        rows.append((level, found[1][:, 0].sum(), counts.sum()))
        split = np.flatnonzero(wanted)
        if level:  # siblings of the summed nodes are had from their parents
            assert (counts[split] <= counts[split ^ 1]).all()
            parents = [p[split // 2] for p in (before[0], before[1])]
            for part, all_of, parent in zip(found, everything, parents):
                assert np.array_equal(parent - part[split], all_of[split ^ 1])
        before[:] = [np.array(p) for p in everything]
        return found

    before = []
    monkeypatch.setattr(boosting, "histograms", counted)
    df, x, y = table(spark)
    booster = boosting.fit_booster(df, INPUTS, "y", ("id",), SETTINGS)
    assert len(booster.trees) == SETTINGS.rounds
    assert all(some == every if not level else 0 < some <= every / 2 for level, some, every in rows)
    want = plain_booster(x, y, booster.edges, SETTINGS)
    got = predicted(booster, df)
    assert np.allclose([got[i] for i in range(len(y))], want, atol=1e-6)


def test_trees_see_their_shares():
    ids = np.random.default_rng(1).integers(-(2**62), 2**62, 20_000)
    seen = [boosting.drawn(ids, tree, 0.8, 42) for tree in range(3)]
    assert all(abs(s.mean() - 0.8) < 0.02 for s in seen)
    assert abs((seen[0] & seen[1]).mean() - 0.64) < 0.02
    assert boosting.drawn(ids, 0, 1.0, 42).all()


def test_errors_fall(spark):
    df, x, y = table(spark)
    errors = []
    for rounds in (1, 4, 12):
        booster = boosting.fit_booster(df, INPUTS, "y", ("id",), boosting.Settings(rounds=rounds, depth=3))
        got = predicted(booster, df)
        errors.append(np.mean([(got[i] - t) ** 2 for i, t in enumerate(y)]))
    assert errors[0] > errors[1] > errors[2]


def test_degenerate_tables(spark):
    schema = "id bigint, a double, b double, c double, y double"
    none = boosting.fit_booster(spark.createDataFrame([], schema), INPUTS, "y", ("id",), SETTINGS)
    assert none.trees == [] and none.base == 0.0
    flat = spark.createDataFrame([(i, 1.0, 1.0, 1.0, 3.0) for i in range(50)], schema)
    booster = boosting.fit_booster(flat, INPUTS, "y", ("id",), SETTINGS)
    assert set(predicted(booster, flat).values()) == {3.0}
    one = spark.createDataFrame([(0, 1.0, 2.0, 3.0, 7.0)], schema)
    assert predicted(boosting.fit_booster(one, INPUTS, "y", ("id",), SETTINGS), one) == {0: 7.0}


def test_trained_models_are_fitted_side_by_side(workspace, monkeypatch):
    meet = threading.Barrier(3)  # broken, if a fit waits for another one to end
    pipeline, fit = models.tree_pipeline, boosting.fit_booster

    def small_pipeline(**settings):
        meet.wait(100)
        return pipeline(**{**settings, "maxIter": 2, "maxDepth": 2})

    def small_fit(rows):
        meet.wait(100)
        return fit(rows, settings=boosting.Settings(rounds=2, depth=2))

    monkeypatch.setattr(models, "tree_pipeline", small_pipeline)
    monkeypatch.setattr(boosting, "fit_booster", small_fit)
    found = forecast_queries._trained_predictions(workspace)
    assert {r.model for r in found.select("model").distinct().collect()} == set(forecast_queries.TRAINED_KINDS)


def test_every_node_is_summed_if_a_target_is_unknown(spark, monkeypatch):
    sums, wanted = boosting.histograms, []

    def seen(*args):
        wanted.append(args[6].all())
        return sums(*args)

    monkeypatch.setattr(boosting, "histograms", seen)
    df, _, _ = table(spark, n=200)
    boosting.fit_booster(df, INPUTS, "y", ("id",), SETTINGS)
    assert not all(wanted)
    wanted.clear()
    gap = df.selectExpr("id", "a", "b", "c", "IF(id = 7, NULL, y) AS y")
    boosting.fit_booster(gap, INPUTS, "y", ("id",), SETTINGS)
    assert wanted and all(wanted)
