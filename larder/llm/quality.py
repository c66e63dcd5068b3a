"""Quality of texts by a factorisation machine."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+")
THRESHOLD = 0.3
STATISTICS = 14


@dataclass(frozen=True)
class Settings:
    """Bounds and rates of the model.

    ``per_label``: labelled documents of each label that it is fitted on, at most;
    ``buckets``: words are hashed to so many; ``factors``: width of the interactions;
    ``epochs``, ``rate``, ``decay``, ``batch``: of the fit; ``seed``: of its start and order.
    """

    per_label: int = 5_000
    buckets: int = 1 << 16
    factors: int = 8
    epochs: int = 8
    rate: float = 0.05
    decay: float = 1e-4
    batch: int = 64
    seed: int = 17


def statistics(text: str, tokens: list[str], counts: Counter, metadata: Sequence[float | None]) -> list[float]:
    """Structure of a text, and how its metadata fit it. All are finite for any text."""
    n = len(text)
    letters = sum(map(len, filter(str.isalpha, tokens)))
    marks = [t for t in tokens if not t[0].isalnum()]
    lines = text.split("\n")
    filled = [line for line in lines if line.strip()]
    upper = sum(1 for t in tokens if len(t) > 1 and t.isupper())
    known = max(1, len(tokens))
    total = max(1, n)
    return [
        np.log1p(n),
        np.log1p(len(tokens)),
        letters / total,
        sum(map(len, marks)) / total,
        sum(1 for t in marks if len(t) > 1) / known,
        sum(1 for t in tokens if t.isdigit()) / known,
        upper / known,
        letters / max(1, len(tokens) - len(marks)),
        len(counts) / known,
        max(counts.values(), default=0) / known,
        np.log1p(len(filled)),
        len(set(filled)) / max(1, len(filled)),
        np.log1p(max(map(len, lines))),
        text.count(" ") / total,
        *(v for m in metadata for v in _against(m, n)),
    ]


def _against(value: float | None, n: int) -> tuple[float, float]:
    """A number that describes a text: whether it is there, and how far it is from its length."""
    if value is None or value != value:
        return 0.0, 0.0
    return 1.0, float(np.log1p(abs(value)) - np.log1p(n))


class Features:
    """Texts to sparse rows: statistics first, then hashed words."""

    def __init__(self, buckets: int, limit: int = 1 << 18) -> None:
        self.buckets, self.limit = buckets, limit
        self.place: dict[str, int] = {}

    def bucket(self, word: str) -> int:
        at = self.place.get(word)
        if at is None:
            if len(self.place) >= self.limit:
                self.place.clear()
            at = self.place[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % self.buckets
        return at

    def row(self, text: str | None, metadata: Sequence[float | None]) -> tuple[list[float], np.ndarray, np.ndarray]:
        """(statistics, buckets, weights): each word weighs by the log of its count, the text 1."""
        tokens = TOKEN.findall(text or "")
        counts = Counter(t.lower() for t in tokens)
        at = np.fromiter((self.bucket(w) for w in counts), np.int64, len(counts))
        weight = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
        norm = np.sqrt(weight @ weight)
        return statistics(text or "", tokens, counts, metadata), at, weight / norm if norm else weight


@dataclass
class Model:
    """Weights of a factorisation machine over statistics and hashed words.

    ``mean`` and ``spread`` bring statistics to one scale; ``linear`` and ``factors`` have a
    row per input, statistics first.
    """

    mean: np.ndarray
    spread: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    buckets: int

    def inputs(self, rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(column, value, first): rows laid end to end."""
        n = len(self.mean)
        stats = np.clip((np.array([r[0] for r in rows]) - self.mean) / self.spread, -4, 4) / np.sqrt(n)
        sizes = np.array([n + len(r[1]) for r in rows])
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        column, value = np.empty(sizes.sum(), np.int64), np.empty(sizes.sum())
        for start, s, (_, at, weight) in zip(first, stats, rows):
            column[start : start + n], value[start : start + n] = np.arange(n), s
            column[start + n : start + n + len(at)] = at + n
            value[start + n : start + n + len(at)] = weight
        return column, value, first

    def margins(self, column: np.ndarray, value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(margin, sums of factors): in time linear in the inputs.

        All pairs of inputs of a row interact; half of the square of the sum less the sum of
        squares is their sum.
        """
        scaled = self.factors[column] * value[:, None]
        sums = np.add.reduceat(scaled, first)
        squares = np.add.reduceat(scaled * scaled, first)
        linear = np.add.reduceat(self.linear[column] * value, first)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def scores(self, rows: list[tuple]) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        return _chance(self.margins(*self.inputs(rows))[0])


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def train(rows: list[tuple], target: np.ndarray, weight: np.ndarray, settings: Settings) -> Model:
    """Fit by adaptive gradient steps on the logistic loss; the same rows give the same model."""
    rng = np.random.default_rng(settings.seed)
    stats = np.array([r[0] for r in rows])
    width = stats.shape[1] + settings.buckets
    prior = np.clip((weight * target).sum() / weight.sum(), 0.01, 0.99)
    model = Model(
        stats.mean(axis=0),
        stats.std(axis=0) + 1e-6,
        float(np.log(prior / (1 - prior))),
        np.zeros(width),
        rng.normal(0, 0.05, (width, settings.factors)),
        settings.buckets,
    )
    past_linear, past_factors, past_bias = np.full(width, 1e-2), np.full((width, 1), 1e-2), 1e-2
    for _ in range(settings.epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), settings.batch):
            part = order[start : start + settings.batch]
            column, value, first = model.inputs([rows[i] for i in part])
            margin, sums = model.margins(column, value, first)
            slope = (_chance(margin) - target[part]) * weight[part] / len(part)
            sizes = np.diff(np.append(first, len(column)))
            owner = np.repeat(np.arange(len(part)), sizes)
            by_linear = slope[owner] * value
            by_factors = by_linear[:, None] * (sums[owner] - model.factors[column] * value[:, None])
            used, where = np.unique(column, return_inverse=True)
            g_linear = np.bincount(where, by_linear) + settings.decay * model.linear[used]
            g_factors = np.stack(
                [np.bincount(where, by_factors[:, k]) for k in range(settings.factors)], axis=1
            ) + settings.decay * model.factors[used]
            past_linear[used] += g_linear**2
            past_factors[used] += (g_factors**2).mean(axis=1, keepdims=True)
            past_bias += slope.sum() ** 2
            model.linear[used] -= settings.rate * g_linear / np.sqrt(past_linear[used])
            model.factors[used] -= settings.rate * g_factors / np.sqrt(past_factors[used])
            model.bias -= settings.rate * slope.sum() / np.sqrt(past_bias)
    return model


def held_out(id_col: str):
    """Whether a row is held out: CRC-32 of the id as text, mod 5, is 0. False for a NULL id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
    metadata: Sequence[str], settings: Settings,
) -> tuple[pd.DataFrame, float]:
    """(rows with text, metadata and target, share of label 1 among all labelled ids).

    Of each label the ``per_label`` ids that come first by a hash are taken, and as many rows
    of documents at most, so the sample is bounded however often an id is repeated. An id with
    labels that disagree has the one given more often; equally often, 0.
    """
    usable = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .where(~held_out(id_col))
        .groupBy(F.col(id_col).alias("id"))
        .agg((F.avg(F.col(label_col)) > 0.5).cast("int").alias("target"))
    )
    counts = {r.target: r["count"] for r in usable.groupBy("target").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    order = F.xxhash64("id", F.lit(5))
    drawn = [usable.where(F.col("target") == t).orderBy(order, "id").limit(settings.per_label) for t in (0, 1)]
    ids = F.broadcast(drawn[0].union(drawn[1]))  # 2 * per_label rows at most
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        *(F.col(m).cast("double").alias(f"m{i}") for i, m in enumerate(metadata)),
    ).join(ids, "id")
    first = rows.orderBy(order, "id", F.xxhash64("text")).limit(2 * settings.per_label)
    return first.toPandas(), share


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    metadata: Sequence[str] = (),
    settings: Settings = Settings(),
) -> Model:
    """Learn from labelled rows that are not held out.

    Rows are weighted so that the labels have the shares they have among all labelled ids:
    scores are then chances. Without a labelled row every text scores one half, with one
    label every text scores near to it.
    """
    sample, share = labelled_sample(docs, labels, id_col, text_col, label_col, metadata, settings)
    n = STATISTICS + 2 * len(metadata)
    if sample.empty:
        width = n + settings.buckets
        return Model(
            np.zeros(n), np.ones(n), 0.0, np.zeros(width), np.zeros((width, settings.factors)), settings.buckets
        )
    features = Features(settings.buckets)
    named = [f"m{i}" for i in range(len(metadata))]
    numbers = zip(*(sample[c] for c in named)) if named else [()] * len(sample)
    rows = [features.row(t, m) for t, m in zip(sample["text"], numbers)]
    target = sample["target"].to_numpy(float)
    seen = target.mean()
    weight = np.where(target == 1, share / max(seen, 1e-9), (1 - share) / max(1 - seen, 1e-9))
    return train(rows, target, np.maximum(weight, 1e-3), settings)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    metadata: Sequence[str] = (),
    threshold: float = THRESHOLD,
    settings: Settings = Settings(),
) -> DataFrame:
    """One row per document: id, held_out, score, predicted.

    The score is the chance, 0 to 1, that a whole text has label 1, by hashed words, structure
    and the numeric columns named in ``metadata``; id, labels and other columns are no input.
    NULL texts count as empty; empty texts are scored by their structure. Metadata may be
    NULL. A document with a NULL id is scored and neither learned from nor held out; repeated
    rows are rows of their own; labels of ids that are no document, and labels other than 0
    and 1, do nothing; an empty table gives no rows.
    """
    model = fit(docs, labels, id_col, text_col, label_col, metadata, settings)
    held = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size, see Settings

    @F.pandas_udf("double")
    def chance(columns: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        features = Features(held.value.buckets)
        for text, numbers in columns:
            found = np.zeros(len(text))
            rows, start, entries = [], 0, 0
            for i, (t, m) in enumerate(zip(text, numbers)):
                rows.append(features.row(t, m))
                entries += len(rows[-1][1])
                if entries > 1 << 18 or i == len(text) - 1:
                    found[start : i + 1] = held.value.scores(rows)
                    rows, start, entries = [], i + 1, 0
            yield pd.Series(found)

    numbers = F.array(*(F.col(m).cast("double") for m in metadata)).cast("array<double>")
    scored = docs.select(
        F.col(id_col).alias("id"),
        held_out(id_col).alias("held_out"),
        chance(F.col(text_col), numbers).alias("score"),
    )
    return scored.select(
        F.col("id").alias(id_col),
        "held_out",
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
