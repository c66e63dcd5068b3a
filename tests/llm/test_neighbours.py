"""Components, SimHash and vector near-dedup against brute force."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from xxhash import xxh64_intdigest

from larder.llm import buckets, simhash, vectors
from larder.llm.components import components, labels


def brute_components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = np.random.default_rng(5)
    edges = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(80)] + [(7, 7)],
        "random": [tuple(map(int, rng.integers(0, 300, 2))) for _ in range(220)],
        "none": [],
    }[shape]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.component for r in components(frame).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert got == brute_components(nodes, [e for e in edges if e[0] != e[1]])


def test_labels_follow_long_chains():
    order = np.random.default_rng(1).permutation(500)
    label = labels(500, order[:-1], order[1:])
    assert (label == 0).all()


def test_any_two_of_a_bucket_meet_once(spark):
    rows = [(1, i) for i in range(100)] + [(2, i) for i in range(3)] + [(3, 0)]
    frame = spark.createDataFrame(rows, "k int, v bigint")
    cells = buckets.block_pairs(frame, "k", "v", block=30).collect()
    met = Counter()
    groups = {}
    for r in cells:
        groups.setdefault(tuple(r.cell), []).append((r.v, r.side))
    for (key, low, high), members in groups.items():
        first = [v for v, s in members if s == 0]
        second = [v for v, s in members if s == 1]
        pairs = (
            [(a, b) for a in first for b in second]
            if low != high
            else [(a, b) for i, a in enumerate(first) for b in first[i + 1 :]]
        )
        met.update((key, *sorted(p)) for p in pairs)
        assert len(first) < 100
    assert set(met.values()) == {1} and len(met) == 100 * 99 // 2 + 3


# -- SimHash ---------------------------------------------------------------------


def plain_fingerprint(text, shingle=4):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    runs = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(texts):
    odd = [None, "", " \n\t", "One", "ÀB c\xa0d e\x85f", "a b c d e " * 30]
    for text in [*list(texts.values())[:60], *odd]:
        assert simhash.fingerprint(text) == [plain_fingerprint(text)]
    long = "x y z w v " * 40_000
    assert simhash.fingerprint(long)[0] == simhash.fingerprint("x y z w v " * 300)[0]
    assert len(set(simhash.fingerprint("a b c d e f", lanes=4))) == 4


def test_spark_hashes_alike(spark):
    """The hash of the contract is the engine's own."""
    got = spark.sql("SELECT xxhash64('the cat sat on') AS h").first().h
    assert got % (1 << 64) == xxh64_intdigest(b"the cat sat on", 42)


@pytest.mark.parametrize("total", [100, 10**6, 10**9, 10**12])
@pytest.mark.parametrize("distance", [1, 4, 6, 9])
def test_plans_are_complete(total, distance):
    rng = np.random.default_rng(total % 97 + distance)
    bits = (rng.random((500, 64)) < rng.uniform(0.2, 0.8, 64)).astype(float)
    plan = simhash.choose_plan(total, bits.T @ bits * (total / 500), distance)
    assert sorted(b for p in plan.parts for b in p) == list(range(64))
    assert sum(d + 1 for d in plan.distances) == distance + 1
    masks = [m % (1 << 64) for m in plan.masks()]
    for _ in range(300):  # any difference within the distance is covered by a mask
        flipped = sum(1 << int(b) for b in rng.choice(64, distance, replace=False))
        assert any(not flipped & m for m in masks)


def near_marks(rng, groups, size, flips):
    marks = set()
    for _ in range(groups):
        base = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(size):
            bits = rng.choice(64, int(rng.integers(0, flips + 1)), replace=False)
            marks.add(base ^ sum(1 << int(b) for b in bits))
    return sorted(marks)


@pytest.mark.parametrize("block", [20, 4096])
def test_no_link_is_lost(spark, monkeypatch, block):
    monkeypatch.setattr(buckets.block_pairs, "__defaults__", (block,))
    marks = np.array(near_marks(np.random.default_rng(3), 30, 40, 5), np.uint64)
    signed = marks.view(np.int64).tolist()
    nodes = spark.createDataFrame(list(enumerate(signed)), "node bigint, fp0 bigint")
    found = components(simhash.link_nodes(nodes, ["fp0"], 4, 4))
    got = {r.node: r.component for r in found.collect()}
    apart = np.bitwise_count(marks[:, None] ^ marks[None, :])
    a, b = np.nonzero(apart <= 4)
    expected = labels(len(marks), a, b)
    assert all(got.get(i, i) == expected[i] for i in range(len(marks)))


def test_crowds_give_stars():
    """A cell of a thousand near copies gives one link each, not half a million."""
    marks = np.arange(1000, dtype=np.int64) % 16
    batch = pa.RecordBatch.from_pydict(
        {"side": np.zeros(1000, np.int32), "node": np.arange(1000), "fp0": marks}
    )
    links = list(simhash.link_cells(np.zeros(1000, np.int64), batch, ["fp0"], 4))
    assert sum(x.num_rows for x in links) == 999


def test_near_duplicates_of_documents(spark, documents, texts, odd, empty):
    ids = sorted(texts)
    marks = np.array([plain_fingerprint(texts[i]) for i in ids], np.uint64)
    a, b = np.nonzero(np.bitwise_count(marks[:, None] ^ marks[None, :]) <= 4)
    label = labels(len(ids), a, b)
    rows = {r.doc_id: r for r in simhash.near_duplicates(documents).collect()}
    for i, number in enumerate(ids):
        assert rows[number].fingerprint == f"{int(marks[i]):016x}"
        assert rows[number].component_id == ids[label[i]]
    rows = simhash.near_duplicates(odd).collect()
    by = {r.doc_id: r.component_id for r in rows}
    assert len(rows) == 11 and by[1] == by[2] == by[9] == 1 and by[3] == by[4] == 3
    assert by[None] == by[6] == 6
    assert simhash.near_duplicates(empty).count() == 0


def jaccard(a, b):
    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def test_near_copies_go_and_other_texts_stay(spark, documents):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(4000)]
    rows, base = [], []
    for g in range(40):
        text = rng.choice(words, 400).tolist()
        base.append(" ".join(text))
        rows.append((10 * g, base[-1], "x"))
        for c in (1, 2):
            copy = list(text)
            for place in rng.choice(400, 3, replace=False):
                copy[place] = "changed"
            rows.append((10 * g + c, " ".join(copy), "x"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = {r.doc_id for r in simhash.drop_near_copies(docs).collect()}
    assert kept >= {10 * g for g in range(40)}
    assert len(kept) <= 41  # similarity of copies is about 0.93
    assert jaccard(rows[0][1], rows[1][1]) > 0.9


def test_near_copy_stage_of_odd_rows(odd, odd_file, empty):
    for docs in (odd, odd_file):
        kept = simhash.drop_near_copies(docs)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 6, 7, 8]
    assert simhash.drop_near_copies(empty).count() == 0


# -- vectors -----------------------------------------------------------------------


def brute_vectors(rows, cosine=0.95):
    good = [
        (n, np.array(v, float) / np.abs(np.array(v, float)).max())
        for n, v in rows
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links, edges = Counter(), []
    for i, (a, x) in enumerate(good):
        for b, y in good[i + 1 :]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                links[a] += 1
                links[b] += 1
                edges.append((a, b))
    parts = brute_components([n for n, _ in rows], edges)
    return {n: (links[n], parts[n], n == parts[n]) for n, _ in rows}


def crowd(seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for size, spread in ((1, 0), (40, 0.1), (150, 0.25), (3, 0.3), (60, 0.4), (2, 0.0)):
        base = rng.standard_normal(16)
        for _ in range(size):
            rows.append((base + spread * rng.standard_normal(16) * 0.5).tolist())
    rows += rng.standard_normal((200, 16)).tolist()
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_vectors_against_all_pairs(spark):
    rows = crowd()
    rows += [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [None] + [1.0] * 15)]
    rows += [(1004, [float("nan")] * 16), (1005, [float("inf")] + [0.0] * 15)]
    rows += [(1006, rows[0][1]), (1007, rows[0][1]), (1008, [2 * x for x in rows[0][1]])]
    rows += [(1009, [1.0, 0.0]), (1010, [1.0, 0.01]), (1011, [1e-300] * 4), (1012, [1e300] * 4)]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = vectors.near_duplicate_vectors(docs, window=8).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute_vectors(rows)
    assert len(got) == len(rows)


def test_vectors_empty_and_repeated(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>, node int")
    assert vectors.near_duplicate_vectors(none).count() == 0
    twice = spark.createDataFrame(
        [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])], "vec_id bigint, embedding array<float>"
    )
    rows = vectors.near_duplicate_vectors(twice).collect()
    assert [r.n_links for r in rows] == [2, 2, 2]
    assert Counter(r.kept for r in rows) == {True: 2, False: 1}


def test_passes_grow_with_the_table():
    assert vectors.passes_needed(10, 0.95) == 1
    few, many = vectors.passes_needed(10**5, 0.95), vectors.passes_needed(10**9, 0.95)
    assert 5 < few < many < 200


def test_dense_region_loses_no_link(spark):
    """A third of the rows in one cone, with lone pairs just above the threshold inside it."""
    rng = np.random.default_rng(1)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    n, dense, pairs = 4500, 1500, 60
    x = unit(rng.normal(size=(n, 64)))
    x[:dense] = unit(np.sqrt(0.9) * unit(rng.normal(size=64)) + np.sqrt(0.1) * x[:dense])
    for i, j in rng.permutation(dense)[: 2 * pairs].reshape(-1, 2):
        away = rng.normal(size=64)
        x[j] = 0.952 * x[i] + np.sqrt(1 - 0.952**2) * unit(away - away @ x[i] * x[i])
    links = (x @ x.T >= 0.95).sum(axis=1) - 1
    assert links.sum() >= 2 * pairs
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r.n_links for r in vectors.near_duplicate_vectors(frame).collect()}
    assert [got[i] for i in range(n)] == links.tolist()
