"""Trend with change points and multiplicative seasons.

Demand is trend times season. The trend is linear with a possible bend at each candidate day,
and an L1 penalty keeps only the bends that matter; the season is a Fourier series around one.
Around a guess of both parts their product is linear in their coefficients, so a round fits
them together from one Gram matrix that Spark sums up; only matrices of bounded size are solved
in Python.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.models import non_negative
from larder.session import stage


@dataclass(frozen=True)
class Settings:
    """``bends``: candidate days, evenly over the first ``reach`` of the history; ``weekly`` and
    ``yearly``: orders of the seasons; ``ridge``: pull on seasons, as a share of their weight;
    ``rounds``: times that both are fitted, each around the last; ``penalties``: steps of the
    L1 path, down to ``least`` of the penalty at which no bend is left.
    """

    bends: int = 25
    reach: float = 0.8
    weekly: int = 3
    yearly: int = 10
    ridge: float = 1e-3
    rounds: int = 3
    penalties: int = 25
    least: float = 1e-3


def candidate_places(settings: Settings) -> list[float]:
    """Where bends may be, as shares of the history."""
    return [settings.reach * (i + 1) / settings.bends for i in range(settings.bends)]


def trend_terms(bends: Sequence[float]) -> Column:
    """Array of 1, the place, and a hinge at each bend."""
    listed = ", ".join(f"{b!r}D" for b in bends)
    hinges = f"transform(array({listed}), b -> greatest(place - b, 0D))" if listed else "array()"
    return F.expr(f"concat(array(1D, place), {hinges})")


def season_terms(settings: Settings) -> Column:
    """Array of sines and cosines of the week and the year."""
    turns = [
        2 * math.pi * k / length
        for length, order in ((7.0, settings.weekly), (365.25, settings.yearly))
        for k in range(1, order + 1)
    ]
    day = "CAST(unix_date(CAST(ds AS DATE)) AS DOUBLE)"
    listed = ", ".join(f"{t!r}D" for t in turns)
    return F.expr(f"flatten(transform(array({listed}), t -> array(sin({day} * t), cos({day} * t))))")


def _scaled(terms: Column, factor: str) -> Column:
    return F.transform(terms, lambda t: t * F.col(factor))


def placed(days: DataFrame, spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``place``: 0 on the first day of a series' history, 1 on the last, beyond 1 later."""
    day = F.unix_date(F.col("ds").cast("date"))
    joined = days.join(spans, list(keys)) if keys else days.crossJoin(F.broadcast(spans))  # one row
    return joined.withColumn(
        "place", (day - F.col("first_day")) / F.greatest(F.col("last_day") - F.col("first_day"), F.lit(1)).cast("double")
    )


def history_spans(days: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """(keys, first_day, last_day, scale) of each series."""
    day = F.unix_date(F.col("ds").cast("date"))
    return days.groupBy(*keys).agg(
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.greatest(F.avg(F.abs(F.col(target).cast("double"))), F.lit(1e-9)).alias("scale"),
    )


def normal_equations(rows: DataFrame, terms: Column, value: Column, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, gram): per series, the sums of products of all terms and the value, row by row.

    Tasks multiply whole matrices; what they send is one matrix per series and task, summed by
    Spark. A series has a row per day, so even one alone is no burden for a task.
    """
    names = list(keys)
    plain = rows.select(*names, terms.alias("x"), value.cast("double").alias("y"))
    if names:
        plain = plain.repartition(*names).sortWithinPartitions(*names)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.select(*names).schema)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            x = np.concatenate([x, batch.column("y").to_numpy(zero_copy_only=False)[:, None]], axis=1)
            starts = np.zeros(n, bool)
            starts[0] = True
            for name in names:
                column = batch.column(name).to_pylist()
                starts[1:] |= np.array([a != b for a, b in zip(column, column[1:])], bool)
            first = np.flatnonzero(starts)
            grams = [(x[a:b].T @ x[a:b]).ravel() for a, b in zip(first, [*first[1:], n])]
            columns = [batch.column(name).take(pa.array(first)) for name in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(grams)], names=[*names, "gram"])

    parts = plain.mapInArrow(multiply, f"{kinds}{', ' if names else ''}gram array<double>")
    cells = parts.select(*names, F.posexplode("gram").alias("cell", "part"))
    summed = cells.groupBy(*names, "cell").agg(F.sum("part").alias("total"))
    listed = F.sort_array(F.collect_list(F.struct("cell", "total")))
    whole = summed.groupBy(*names).agg(F.transform(listed, lambda c: c["total"]).alias("gram"))
    return whole.where(F.size("gram") > 0)


def unpacked(gram: Sequence[float]) -> tuple[np.ndarray, np.ndarray, float]:
    """(X'X, X'y, y'y)."""
    side = int(round(len(gram) ** 0.5))
    whole = np.array(gram).reshape(side, side)
    return whole[:-1, :-1], whole[:-1, -1], float(whole[-1, -1])


def solve_bends(gram: Sequence[float], n: int, free: int, settings: Settings) -> np.ndarray:
    """All coefficients, with the bends of the L1 path that have the least BIC.

    The first ``free`` terms are level, slope and seasons; they carry no L1 penalty and are
    solved for exactly, so coordinate descent moves bends only, on the Gram matrix of what the
    free terms leave of them. Each penalty starts from the solution of the one before. Kept bends
    are fitted again without penalty, and the criterion compares those fits.
    """
    xx, xy, yy = unpacked(gram)
    pull = np.full(len(xy), 1e-9)
    pull[2:free] = settings.ridge
    xx = xx + np.diag(pull * np.diag(xx) + 1e-12)

    def refit(kept: tuple[int, ...]) -> tuple[float, np.ndarray]:
        at = np.concatenate([np.arange(free), np.array(kept, int) + free])
        beta = np.zeros(len(xy))
        beta[at] = np.linalg.lstsq(xx[np.ix_(at, at)], xy[at], rcond=1e-12)[0]
        rest = max(yy - 2 * beta @ xy + beta @ xx @ beta, 1e-12 * max(yy, 1e-12))
        return n * np.log(rest / n) + (free + 2 * len(kept)) * np.log(n), beta

    best = refit(())
    mixed = np.linalg.lstsq(xx[:free, :free], xx[:free, free:], rcond=1e-12)[0]
    left = xx[free:, free:] - xx[free:, :free] @ mixed
    slope = xy[free:] - mixed.T @ xy[:free]
    top = np.abs(slope).max(initial=0.0)
    if top <= 0:
        return best[1]
    weight = np.maximum(np.diag(left), 1e-12)
    beta, seen = np.zeros(len(slope)), {()}
    still = 1e-5 * max(yy, 1e-12) ** 0.5
    for penalty in top * np.geomspace(1, settings.least, settings.penalties):
        moving = np.arange(len(beta))
        for turn in range(200):
            most = 0.0
            for j in moving:
                toward = slope[j] + weight[j] * beta[j]
                change = math.copysign(max(abs(toward) - penalty, 0.0), toward) / weight[j] - beta[j]
                if change:
                    beta[j] += change
                    slope -= left[j] * change
                    most = max(most, abs(change) * weight[j] ** 0.5)
            if most < still:
                if len(moving) == len(beta):
                    break
                moving = np.arange(len(beta))  # done with the bends in use; see whether others move
            elif turn:
                moving = np.flatnonzero(beta)
        kept = tuple(np.flatnonzero(beta).tolist())
        if kept not in seen and len(kept) + free < n:
            seen.add(kept)
            best = min(best, refit(kept), key=lambda f: f[0])
    return best[1]


def _dot(terms: Column, weights: str) -> Column:
    products = F.zip_with(terms, F.col(weights), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def _trend(settings: Settings) -> Column:
    return _dot(trend_terms(candidate_places(settings)), "trend")


def _season(settings: Settings) -> Column:
    return F.lit(1.0) + _dot(season_terms(settings), "season")


def fit_trend(
    days: DataFrame, keys: Sequence[str] = (), target: str = "actual", settings: Settings = Settings()
) -> DataFrame:
    """One row per series: keys, first_day, last_day, scale, trend, season, bends.

    ``days`` has a row per day and series; rows with a NULL day or target count for nothing.
    Trend coefficients are for the target divided by ``scale``, its mean size, over places from
    0 to 1; ``bends`` lists the kept ones as (day, change of slope per day). Without ``keys``
    all rows are one series. An empty frame gives no rows.
    """
    names = list(keys)
    known = days.where(F.col(target).isNotNull() & F.col("ds").isNotNull())
    places = candidate_places(settings)
    spans = stage(
        history_spans(known, names, target).where(F.col("first_day").isNotNull()), "spans"
    )
    value = F.col(target).cast("double") / F.col("scale")
    rows = stage(
        placed(known.select(*names, "ds", target), spans, names).withColumn("value", value), "places"
    )
    counts = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    seasons, bends = 2 * (settings.weekly + settings.yearly), len(places)
    flat = F.concat(F.array(F.lit(1.0)), F.array_repeat(F.lit(0.0), bends + 1))
    none = F.array_repeat(F.lit(0.0), seasons)
    model = spans.withColumns({"trend": flat, "season": none})
    free = 2 + seasons

    @F.pandas_udf("array<double>")
    def solved(gram: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([solve_bends(g, int(c), free, settings).tolist() for g, c in zip(gram, n)])

    for _ in range(settings.rounds):
        # value = trend * (1 + season), around the last guess of both.
        part = model.select(*names, "trend", "season")
        around = (rows.join(part, names) if names else rows.crossJoin(F.broadcast(part))).withColumns(
            {"level": _trend(settings), "shape": _season(settings)}
        )
        lines = _scaled(trend_terms(places), "shape")
        terms = F.concat(
            F.slice(lines, 1, 2), _scaled(season_terms(settings), "level"), F.slice(lines, 3, bends)
        )
        target_now = F.col("value") + F.col("level") * (F.col("shape") - 1)
        grams = normal_equations(around, terms, target_now, names)
        found = _joined(grams, counts, names).select(*names, solved("gram", "n").alias("beta"))
        model = stage(
            _joined(spans, found, names).select(
                *spans.columns,
                F.concat(F.slice("beta", 1, 2), F.slice("beta", free + 1, bends)).alias("trend"),
                F.slice("beta", 3, seasons).alias("season"),
            ),
            "trend",
        )
    span = F.greatest(F.col("last_day") - F.col("first_day"), F.lit(1))
    at = F.expr(f"array({', '.join(f'{p!r}D' for p in places)})")
    hinges = F.arrays_zip(at.alias("place"), F.slice("trend", 3, len(places)).alias("change"))
    return model.withColumn(
        "bends",
        F.transform(
            F.filter(hinges, lambda h: h["change"] != 0),
            lambda h: F.struct(
                F.date_from_unix_date((F.col("first_day") + F.round(h["place"] * span)).cast("int")).alias("day"),
                (h["change"] * F.col("scale") / span).alias("change"),
            ),
        ),
    )


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys) if keys else left.crossJoin(F.broadcast(right))  # one row each


def predict_trend(
    model: DataFrame, days: DataFrame, keys: Sequence[str] = (), settings: Settings = Settings()
) -> DataFrame:
    """Add ``pred`` to the rows of ``days`` whose series has a model: trend times season.

    The last slope goes on after the history; demand is not below zero.
    """
    names = list(keys)
    part = model.select(*names, "first_day", "last_day", "scale", "trend", "season")
    value = _trend(settings) * _season(settings) * F.col("scale")
    return placed(days, part, names).select(*days.columns, non_negative(value).alias("pred"))
