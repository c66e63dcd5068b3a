"""The factorisation machine: its identity, its folds, and held-out accuracy."""

import zlib
from collections import Counter

import numpy as np
import pytest

from larder.llm import quality

SMALL = quality.Settings(buckets=1 << 10, epochs=6)
LABELS = "doc_id bigint, quality int, toxic int"


def area(score, label):
    """Chance that a row of label 1 scores above one of label 0."""
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for value in np.unique(score):
        same = score == value
        rank[same] = rank[same].mean()
    ones = label == 1
    return (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def test_identity_equals_all_pairs():
    rng = np.random.default_rng(1)
    features = quality.Features(50)
    texts = ["", "one", "Two two THREE!! three", "a b c d e f 12 | 13 ***", "x" * 500]
    rows = [features.row(t, (len(t), None)) for t in texts]
    n = quality.STATISTICS + 4
    model = quality.Model(
        rng.random(n), rng.random(n) + 0.5, 0.3, rng.normal(size=n + 50), rng.normal(size=(n + 50, 3)), 50
    )
    for row, score in zip(rows, model.scores(rows)):
        column, value, _ = model.inputs([row])
        margin = model.bias + sum(model.linear[c] * v for c, v in zip(column, value))
        for i in range(len(column)):
            for j in range(i):
                margin += model.factors[column[i]] @ model.factors[column[j]] * value[i] * value[j]
        assert score == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-9)


def test_learns_interactions():
    """Two words that are good together or both absent, and bad alone."""
    rng = np.random.default_rng(0)
    features = quality.Features(64)
    rows, target = [], []
    for _ in range(800):
        a, b = rng.integers(0, 2, 2)
        rows.append(features.row("filler " + "red " * a + "blue " * b, ()))
        rows[-1] = ([0.0] * quality.STATISTICS, *rows[-1][1:])
        target.append(float(a == b))
    target = np.array(target)
    settings = quality.Settings(buckets=64, epochs=30, rate=0.1)
    model = quality.train(rows, target, np.ones(len(rows)), settings)
    assert ((model.scores(rows) > 0.5) == target).mean() > 0.95


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.score_quality(docs, labels, metadata=("n_chars",)).join(labels, "doc_id").toPandas()
    assert got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    test = got[got.held_out]
    assert area(test.score.to_numpy(), test.quality.to_numpy()) > 0.9
    assert test[test.quality == 1].predicted.mean() > 0.95


def test_held_out_labels_change_nothing(spark):
    docs = spark.createDataFrame([(i, f"text {i % 7} word{i % 3}!!") for i in range(60)], "doc_id bigint, text string")
    rows = [(i, i % 2, 0) for i in range(60)]
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in rows]
    scores = [
        sorted(tuple(r) for r in quality.score_quality(docs, spark.createDataFrame(x, LABELS), settings=SMALL).collect())
        for x in (rows, flipped)
    ]
    assert scores[0] == scores[1]


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (2, 0, 1), (2, 1, 0), (3, None, 0), (None, 1, 0), (9, 1, 0), (8, 5, 0), (77, 0, 0)], LABELS
    )
    got = quality.score_quality(odd, labels, settings=SMALL)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd.collect())
    assert all(0 <= r.score <= 1 and not (r.doc_id is None and r.held_out) for r in rows)
    named = quality.score_quality(odd, labels, metadata=("row_key",), settings=SMALL)
    assert named.count() == odd.count()
    assert quality.score_quality(empty, labels, settings=SMALL).count() == 0
    none = quality.score_quality(odd, labels.where("false"), settings=SMALL).collect()
    assert {r.score for r in none} == {0.5}
    one = quality.score_quality(odd, labels.where("quality = 1"), settings=SMALL).collect()
    assert all(r.score > 0.5 for r in one)


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(1, f"copy {i}") for i in range(40)] + [(3, "other")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0)], LABELS)
    settings = quality.Settings(per_label=5)
    sample, _ = quality.labelled_sample(docs, labels, "doc_id", "text", "quality", (), settings)
    assert len(sample) <= 10


def test_features_do_not_depend_on_the_table_of_words():
    small, large = quality.Features(1 << 12, limit=2), quality.Features(1 << 12)
    for text in ("one two three four", "four five one", "İ ß ﬃ é"):
        a, b = small.row(text, ()), large.row(text, ())
        assert a[0] == b[0] and (a[1] == b[1]).all() and (a[2] == b[2]).all()
