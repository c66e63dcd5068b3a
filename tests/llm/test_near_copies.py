"""The pipeline's near-copy stage against brute force around its threshold."""

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from larder.llm import shingles, simhash
from tests.llm.test_neighbours import brute_components


def near_pairs(texts):
    """Pairs of ids whose texts have a Jaccard similarity of 0.8 or more."""
    sets = {}
    for i, text in texts.items():
        words = text.lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    ids = sorted(sets)
    return [
        (a, b)
        for n, a in enumerate(ids)
        for b in ids[n + 1 :]
        if 5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b]))
        and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]


def copies(rng, text, similarity):
    """A copy with about this similarity: a run of words at its end is replaced."""
    shared = 2 * similarity / (1 + similarity)
    kept = round(shared * len(text))
    return text[:kept] + [f"n{x}" for x in rng.integers(0, 10**9, len(text) - kept)]


def test_pairs_around_the_threshold(spark):
    rng = np.random.default_rng(4)
    rows, texts = [], {}
    for g, similarity in enumerate(np.repeat(np.arange(0.75, 0.905, 0.01), 25)):
        base = [f"w{x}" for x in rng.integers(0, 10**9, int(rng.integers(40, 500)))]
        repeated = base[:20] * 40 if g % 5 == 0 else []  # repeats count once
        texts[2 * g] = " ".join(base + repeated)
        texts[2 * g + 1] = " ".join(copies(rng, base, similarity))
    docs = spark.createDataFrame(sorted(texts.items()), "doc_id bigint, text string")
    near = near_pairs(texts)
    assert 150 < len(near) < 300
    expected = set(brute_components(list(texts), near).values())
    assert {r.doc_id for r in simhash.drop_near_copies(docs).collect()} == expected


def test_documents_against_all_pairs(spark, documents, texts):
    expected = set(brute_components(list(texts), near_pairs(texts)).values())
    assert {r.doc_id for r in simhash.drop_near_copies(documents).collect()} == expected


@pytest.mark.parametrize("block", [7, 512])
def test_a_crowd_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(shingles, "BLOCK", block)
    rng = np.random.default_rng(6)
    base = [f"w{x}" for x in range(100)]
    texts = {}
    for i in range(60):
        words = list(base)
        for place in rng.choice(100, int(rng.integers(0, 4)), replace=False):
            words[place] = f"x{i}"
        texts[i] = " ".join(words)
    docs = spark.createDataFrame(sorted(texts.items()), "doc_id bigint, text string")
    expected = set(brute_components(list(texts), near_pairs(texts)).values())
    assert {r.doc_id for r in simhash.drop_near_copies(docs).collect()} == expected


def test_bands_meet_as_often_as_the_model_says():
    rng = np.random.default_rng(2)
    met = []
    for _ in range(400):
        words = rng.integers(0, 1 << 63, 360, np.uint64)
        a, b = (shingles.band_values(x, 14, 4) for x in (words[:320], words[40:]))
        met.append((a == b).mean())  # similarity 280 / 360
    assert abs(np.mean(met) - (280 / 360) ** 4) < 0.03


def set_bits(text):
    """SimHash over distinct runs of five words, bit by bit."""
    words = text.lower().split()
    runs = {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    hashes = [xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_alone_group_near_copies(spark):
    """With bands that nearly nothing shares, pairs of near fingerprints are still found."""
    rng = np.random.default_rng(9)
    texts = {}
    for g in range(60):
        base = [f"w{x}" for x in rng.integers(0, 10**9, 300)]
        texts[2 * g] = " ".join(base)
        texts[2 * g + 1] = " ".join(copies(rng, base, 0.97 if g % 2 else 0.85))
    marks = {i: set_bits(t) for i, t in texts.items()}
    near = [(a, b) for a, b in near_pairs(texts) if (marks[a] ^ marks[b]).bit_count() <= 4]
    assert 15 < len(near) < 60
    expected = set(brute_components(list(texts), near).values())
    docs = spark.createDataFrame(sorted(texts.items()), "doc_id bigint, text string")
    kept = {r.doc_id for r in simhash.drop_near_copies(docs, bands=1, rows=600).collect()}
    assert kept == expected


def test_set_fingerprint_counts_a_run_once():
    rng = np.random.default_rng(3)
    words = [f"w{x}" for x in rng.integers(0, 10**9, 50)]
    for text in (" ".join(words), " ".join(words + words[:20] * 30), "one word", "x"):
        assert simhash.set_fingerprint(shingles.shingle_set(text, 5)) == set_bits(text)
    assert simhash.set_fingerprint(np.zeros(0, np.uint64)) == 0
