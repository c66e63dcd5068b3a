"""Language identification by known words, backing off to character n-grams."""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.session import stage

UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
SPARK_WORD = r"\p{L}+"


@dataclass(frozen=True)
class Settings:
    """Bounds of the model: it is fitted on a sample and kept small enough to broadcast.

    ``docs_per_language``: labelled documents a language is learned from, about;
    ``words``, ``grams``: the most frequent entries kept per language; ``longest``: length of
    the longest n-gram; ``smoothing``: count added to every entry.
    """

    docs_per_language: int = 5_000
    words: int = 30_000
    grams: int = 30_000
    longest: int = 4
    smoothing: float = 0.5


def _grams(word: str, size: int) -> list[str]:
    padded = f"_{word}_"
    return [padded[i : i + size] for i in range(len(padded) - size + 1)]


@dataclass
class Model:
    """Log frequencies per language, as rows of one table: of words, and of n-grams by length."""

    languages: list[str]
    words: dict[str, int]
    grams: list[dict[str, int]]  # longest first
    table: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    @classmethod
    def of(cls, languages: list[str], *logs: dict[str, np.ndarray]) -> Model:
        """From log frequencies of words and then of n-grams, the longest first."""
        rows = [row for entries in logs for row in entries.values()]
        table = np.array(rows, np.float32).reshape(len(rows), len(languages))
        place = iter(range(len(rows)))
        words, *grams = ({key: next(place) for key in entries} for entries in logs)
        return cls(languages, words, grams, table)

    def word_scores(self, word: str) -> np.ndarray:
        """Log frequency of a word in each language.

        An unseen word takes the mean over its known n-grams of the greatest length at
        which it has any; a word without any known character says nothing.
        """
        known = self.words.get(word)
        if known is not None:
            return self.table[known]
        for places in self.grams:
            size = len(next(iter(places), ""))
            hits = [places[g] for g in _grams(word, size) if g in places] if size else []
            if hits:
                return self.table[hits].mean(axis=0)
        return np.zeros(len(self.languages))


def _most_frequent(counts: DataFrame, key: str, limit: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), key)
    kept = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= limit)
    return kept.select("lang", key, "n")


def _log_frequencies(rows, languages: list[str], smoothing: float) -> dict[str, np.ndarray]:
    number = {lang: i for i, lang in enumerate(languages)}
    counts: dict[str, np.ndarray] = {}
    for lang, key, n in rows:
        counts.setdefault(key, np.zeros(len(languages)))[number[lang]] = n
    if not counts:
        return {}
    keys, table = list(counts), np.array(list(counts.values()))
    logs = np.log(table + smoothing) - np.log(table.sum(axis=0) + smoothing * len(keys))
    return dict(zip(keys, logs))


def fit(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    settings: Settings = Settings(),
) -> Model:
    """Learn from the rows for which ``learn`` holds and text and language are not NULL.

    Words and n-grams are counted in Spark over a sample that a hash of the id draws, evenly
    over the table; only the most frequent entries reach the driver.
    """
    labelled = docs.where(learn & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    totals = {r[0]: r[1] for r in labelled.groupBy(lang_col).count().collect()}
    languages = sorted(totals)
    if not languages:
        return Model.of([], {})
    share = F.create_map(
        *(
            F.lit(x)
            for lang in languages
            for x in (lang, min(1.0, settings.docs_per_language / totals[lang]))
        )
    )
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(3)), F.lit(1 << 20)) / float(1 << 20)
    sample = labelled.where(draw < share[F.col(lang_col)])
    counted = (
        sample.select(
            F.col(lang_col).alias("lang"),
            F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(SPARK_WORD), F.lit(0))).alias("word"),
        )
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counted = stage(counted, "word-counts")  # read once per length
    words = _most_frequent(counted, "word", settings.words).collect()
    padded = F.concat(F.lit("_"), F.col("word"), F.lit("_"))
    grams = []
    for size in range(settings.longest, 0, -1):
        places = F.sequence(F.lit(1), F.char_length(padded) - size + 1)
        pieces = counted.where(F.char_length(padded) >= size).select(
            "lang",
            F.explode(F.transform(places, lambda i: F.substring(padded, i, F.lit(size)))).alias("gram"),
            "n",
        )
        summed = pieces.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        rows = _most_frequent(summed, "gram", settings.grams).collect()
        grams.append(_log_frequencies(rows, languages, settings.smoothing))
    return Model.of(languages, _log_frequencies(words, languages, settings.smoothing), *grams)


class Scorer:
    """A model in a worker, with the scores of words it has met, up to ``limit`` of them."""

    current: Scorer | None = None

    def __init__(self, model: Model, limit: int = 1 << 18) -> None:
        self.model, self.limit = model, limit
        self.place: dict[str, int] = {}
        self.scores = np.zeros((1024, len(model.languages)))

    @classmethod
    def of(cls, model: Model) -> Scorer:
        if cls.current is None or cls.current.model.name != model.name:
            cls.current = cls(model)
        return cls.current

    def _row(self, word: str) -> int:
        row = self.place.get(word)
        if row is None:
            row = self.place[word] = len(self.place)
            if row >= len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.scores[row] = self.model.word_scores(word)
        return row

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score); ties go to the first language by name.

        The score is the share of the best language when log likelihoods, damped by the
        square root of the number of words because words of a text hang together, are
        turned into probabilities.
        """
        if not text or not self.model.languages or not any(c.isalpha() for c in text):
            return UNKNOWN, 0.0
        if len(self.place) > self.limit:
            self.place.clear()
            self.scores = self.scores[:1024].copy()
        words = Counter(WORD.findall(text.lower()))
        rows = [self._row(w) for w in words]
        counts = np.fromiter(words.values(), np.float64, len(words))
        total = counts @ self.scores[rows]
        damped = total / math.sqrt(max(1.0, counts.sum()))
        chances = np.exp(damped - damped.max())
        best = int(np.argmax(total))
        return self.model.languages[best], float(chances[best] / chances.sum())


def prediction(docs: DataFrame, model: Model, text: Column) -> Column:
    """(lang_pred, score) of whole texts, as a column of ``docs``.

    ``und`` with score 0 is given to NULL texts and texts without a letter, and to all if
    nothing could be learned.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # of bounded size, see Settings

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer.of(held.value)
        for series in texts:
            yield pd.DataFrame([scorer.predict(t) for t in series], columns=["lang_pred", "score"])

    return predict(text)


def fold(id_col: str) -> Column:
    """0 to 3, from the CRC-32 of the id as text; 2 is held out. NULL for a NULL id."""
    return F.crc32(F.col(id_col).cast("string")) % 4


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    settings: Settings = Settings(),
) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score.

    Learns from the rows that are not held out; a row with a NULL id belongs to no fold:
    it is neither learned from nor held out. Repeated rows are rows of their own; an empty
    table gives no rows; other columns are not read.
    """
    model = fit(docs, fold(id_col) != 2, id_col, text_col, lang_col, settings)
    return docs.select(
        id_col,
        F.coalesce(fold(id_col) == 2, F.lit(False)).alias("held_out"),
        prediction(docs, model, F.col(text_col)).alias("p"),
    ).select(id_col, "held_out", "p.lang_pred", "p.score")


def keep_identified(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    over_chance: float = 1.2,
    settings: Settings = Settings(),
) -> DataFrame:
    """The rows of ``docs`` whose language can be told, with all their columns unchanged.

    Rejected are texts without a letter and texts that no language explains better than
    chance: where n languages were learned, a score of ``over_chance`` / n or less, since a text
    of which nothing is known scores 1 / n. With one language nothing can be told apart, and if
    nothing could be learned neither: then all texts with a letter stay.
    """
    model = fit(docs, fold(id_col) != 2, id_col, text_col, lang_col, settings)
    if not model.languages:
        return docs.where(F.col(text_col).rlike(r"\p{L}"))
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    scored = packed.withColumn("p", prediction(docs, model, F.col(f"row.{text_col}")))
    several = len(model.languages) > 1
    sure = F.col("p.score") > over_chance / len(model.languages) if several else F.lit(True)
    return scored.where((F.col("p.lang_pred") != UNKNOWN) & sure).select("row.*")
