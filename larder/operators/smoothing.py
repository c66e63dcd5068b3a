"""Additive exponential smoothing, fitted to many daily series at once.

Weights and starting states are chosen by a bounded search; a batch of series is one matrix,
so a step of the recursion is one vector operation for all series and all trial weights.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.models import SEASON

# Weights that the search starts from, and their bounds.
GRID = tuple(np.meshgrid([0.1, 0.3, 0.6], [0.01, 0.1], [0.05, 0.2], indexing="ij"))
LEAST, MOST = 1e-3, 0.999
ROUNDS, MOVES = 2, 5
# Series of one matrix, and rows that a task gathers before it fits what is whole.
SERIES = 256
ROWS = 1 << 19


class States:
    """Level, trend and seasonal parts of series (rows) under trial weights (columns)."""

    def __init__(self, level: np.ndarray, trend: np.ndarray, seasonal: np.ndarray) -> None:
        self.level, self.trend, self.seasonal = level, trend, seasonal  # seasonal: season first

    def repeated(self, times: int) -> States:
        return States(
            np.repeat(self.level, times, axis=1),
            np.repeat(self.trend, times, axis=1),
            np.repeat(self.seasonal, times, axis=2),
        )

    def chosen(self, column: np.ndarray) -> States:
        rows = np.arange(len(column))
        return States(
            self.level[rows, column][:, None],
            self.trend[rows, column][:, None],
            self.seasonal[:, rows, column][:, :, None],
        )


def first_states(y: np.ndarray, season: int) -> States:
    """Mean of the first season, its rise to the second, and the first season's shape."""
    first, second = y[:season], y[season : 2 * season]
    level = first.mean(axis=0)
    trend = (second.mean(axis=0) - level) / season
    return States(level[:, None], trend[:, None], (first - level)[:, :, None])


def smooth(
    y: np.ndarray, lengths: np.ndarray, weights: np.ndarray, start: States, errors: list | None = None
) -> tuple[np.ndarray, States]:
    """(sum of squared one-day errors after the first season, states after the last day).

    ``y`` has a row per day and a column per series, of which the first ``lengths`` days count;
    ``weights`` are (level, trend, season) by series and trial. Errors of each day are appended
    to ``errors`` if given.
    """
    alpha, beta, gamma = weights
    per_trend, per_season = alpha * beta, gamma * (1 - alpha)
    level, trend, seasonal = start.level, start.trend, start.seasonal.copy()
    season, whole = len(seasonal), int(lengths.min())
    squared = np.zeros(np.broadcast_shapes(level.shape, alpha.shape))
    for t in range(season, len(y)):
        slot = t % season
        known = level + trend
        surprise = y[t][..., None] - (known + seasonal[slot])
        if t >= whole:
            live = (t < lengths)[:, None]
            surprise = surprise * live
            known = np.where(live, known, level)
        if errors is not None:
            errors.append(surprise)
        squared += surprise * surprise
        level = known + alpha * surprise
        trend = trend + per_trend * surprise
        seasonal[slot] += per_season * surprise
    return squared, States(level, trend, seasonal)


def best_start(y: np.ndarray, lengths: np.ndarray, weights: np.ndarray, start: States) -> States:
    """The starting states with the least squared error for given weights.

    Errors are linear in the starting states: the responses to each of them alone, on a series
    of zeros, are regressors of the errors. A faint pull towards ``start`` makes the choice
    unique and never worse than ``start``.
    """
    season, n = len(start.seasonal), y.shape[1]
    unit = np.eye(season + 2)
    trial = States(
        np.concatenate([start.level, np.tile(unit[0], (n, 1))], axis=1),
        np.concatenate([start.trend, np.tile(unit[1], (n, 1))], axis=1),
        np.concatenate([start.seasonal, np.repeat(unit[2:, None, :], n, axis=1)], axis=2),
    )
    errors: list[np.ndarray] = []
    shown = np.zeros((len(y), n, season + 3))
    shown[:, :, 0] = y
    # The first column follows the series, the others a series of zeros.
    _smooth_columns(shown, lengths, weights, trial, errors)
    e = np.stack(errors)
    response = -e[:, :, 1:]
    gram = np.einsum("tsi,tsj->sij", response, response, optimize=True)
    gram += np.eye(season + 2) * (1e-9 * np.trace(gram, axis1=1, axis2=2)[:, None, None] + 1e-12)
    move = np.linalg.solve(gram, np.einsum("tsi,ts->si", response, e[:, :, 0], optimize=True)[:, :, None])[:, :, 0]
    return States(
        start.level + move[:, :1],
        start.trend + move[:, 1:2],
        start.seasonal + move[:, 2:].T[:, :, None],
    )


def _smooth_columns(y: np.ndarray, lengths: np.ndarray, weights: np.ndarray, start: States, errors: list) -> None:
    """As ``smooth``, with a value of its own for each column and day."""
    alpha, beta, gamma = weights
    per_trend, per_season = alpha * beta, gamma * (1 - alpha)
    level, trend, seasonal = start.level, start.trend, start.seasonal.copy()
    season, whole = len(seasonal), int(lengths.min())
    for t in range(season, len(y)):
        slot = t % season
        known = level + trend
        surprise = y[t] - (known + seasonal[slot])
        if t >= whole:
            live = (t < lengths)[:, None]
            surprise = surprise * live
            known = np.where(live, known, level)
        errors.append(surprise)
        level = known + alpha * surprise
        trend = trend + per_trend * surprise
        seasonal[slot] += per_season * surprise


def fit(y: np.ndarray, lengths: np.ndarray, season: int = SEASON) -> tuple[np.ndarray, States, np.ndarray]:
    """(weights, states after the last day, squared error) of each series, all of two seasons or more.

    The best of a grid is the start; then starting states are solved for and weights are moved
    along each axis, by steps that halve where no move helps. A move is taken only if the
    squared error falls, so it never exceeds the grid's.
    """
    n = y.shape[1]
    rows = np.arange(n)
    start = first_states(y, season)
    grid = np.stack([g.ravel() for g in GRID])
    trials = np.repeat(grid[:, None, :], n, axis=1)
    squared, _ = smooth(y, lengths, trials, start.repeated(grid.shape[1]))
    best = squared.argmin(axis=1)
    weights, error = grid[:, best][:, :, None], squared[rows, best]
    step = np.full((n, 1), 1.0)
    axes = np.concatenate([np.eye(3), -np.eye(3)])
    for _ in range(ROUNDS):
        moved = best_start(y, lengths, weights, start)
        after, _ = smooth(y, lengths, weights, moved)
        better = after[:, 0] < error
        start = States(
            np.where(better[:, None], moved.level, start.level),
            np.where(better[:, None], moved.trend, start.trend),
            np.where(better[None, :, None], moved.seasonal, start.seasonal),
        )
        error = np.where(better, after[:, 0], error)
        for _ in range(MOVES):
            logit = np.log(weights / (1 - weights))
            tried = 1 / (1 + np.exp(-(logit + axes.T[:, None, :] * step)))
            tried = np.clip(tried, LEAST, MOST)
            after, _ = smooth(y, lengths, tried, start.repeated(len(axes)))
            best = after.argmin(axis=1)
            better = after[rows, best] < error
            weights = np.where(better[None, :, None], tried[:, rows, best][:, :, None], weights)
            error = np.where(better, after[rows, best], error)
            step = np.where(better[:, None], step, step / 2)
        step = np.maximum(step, 0.25)
    _, last = smooth(y, lengths, weights, start)
    return weights[:, :, 0], last, error


def forecast_batch(frame: pd.DataFrame, keys: list[str], season: int) -> pd.DataFrame:
    """Test rows of whole series with ``pred`` and ``method``."""
    if keys:
        code = frame.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
    else:
        code = np.zeros(len(frame), np.int64)
    day = pd.to_datetime(frame["ds"]).to_numpy().astype("datetime64[D]").astype(np.int64)
    test, actual = frame["is_test"].to_numpy(bool), frame["actual"].to_numpy(float)
    count = int(code.max()) + 1
    first = np.full(count, np.iinfo(np.int64).max)
    last = np.full(count, np.iinfo(np.int64).min)
    np.minimum.at(first, code[~test], day[~test])
    np.maximum.at(last, code[~test], day[~test])
    lengths = np.where(last >= first, last - first + 1, 0)
    pred, method = np.zeros(len(frame)), np.full(len(frame), "mean", object)
    total = np.bincount(code[~test], actual[~test], count)
    mean = np.divide(total, lengths, out=np.zeros(count), where=lengths > 0)
    pred[test] = mean[code[test]]
    long = np.flatnonzero(lengths >= 2 * season)
    long = long[np.argsort(lengths[long], kind="stable")]  # like lengths share a matrix
    place = np.full(count, -1)
    for start in range(0, len(long), SERIES):
        part = long[start : start + SERIES]
        place[:] = -1
        place[part] = np.arange(len(part))
        y = np.zeros((lengths[part].max(), len(part)))
        mine = place[code] >= 0
        known = mine & ~test
        y[day[known] - first[code[known]], place[code[known]]] = actual[known]
        _, states, _ = fit(y, lengths[part], season)
        wanted = mine & test
        at, steps = place[code[wanted]], day[wanted] - last[code[wanted]]
        slot = (lengths[part][at] - 1 + steps) % season
        pred[wanted] = states.level[at, 0] + states.trend[at, 0] * steps + states.seasonal[slot, at, 0]
        method[wanted] = "holt_winters"
    return frame.loc[test, [*keys, "ds", "actual"]].assign(pred=pred[test], method=method[test])


def forecast_fitted(
    daily: DataFrame, group: Sequence[str] = ("sku", "store_id"), season: int = SEASON
) -> DataFrame:
    """Forecast the test rows of every series from its train rows, with fitted smoothing.

    Input and output are as of ``models.forecast_series``: ``ds``, ``actual``, ``is_test`` at
    daily grain; a series is smoothed over the calendar, and one shorter than two seasons is
    forecast by its mean. A task fits some hundred series as one matrix and holds no more than
    those; one series has a row per day.
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
    rows = daily.select(*keys, "ds", F.col("actual").cast("double").alias("actual"), "is_test")
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "ds") if keys else rows.coalesce(1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += len(batch)
            if keys and count >= ROWS:
                frame = pd.concat(held, ignore_index=True)
                code = frame.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
                whole = code < code[-1]  # the last series may go on in the next batch
                if whole.any():
                    yield forecast_batch(frame[whole].reset_index(drop=True), keys, season)
                held, count = [frame[~whole]], int((~whole).sum())
        if count:
            yield forecast_batch(pd.concat(held, ignore_index=True), keys, season)

    return dealt.mapInPandas(run, schema)
