"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, number bigint, cell string, `a.b` int"


def all_pairs(rows, positives=5, limit=10, low=30, high=90):
    """Rows of (vec_id, vector, label), anchors at ids divisible by 100, by brute force."""
    whole = [
        (i, [math.floor(256 * float(x)) for x in v], label)
        for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    whole = [r for r in whole if sum(x * x for x in r[1]) < 2**61]
    found = []
    for a, (anchor, mine, label) in enumerate(whole):
        if anchor is None or anchor % 100:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(mine, v)), i is None, i or 0, i, other)
            for b, (i, v, other) in enumerate(whole)
            if b != a and len(v) == len(mine)
        )
        for score, _, _, positive, _ in [s for s in scored if s[4] == label][:positives]:
            near = [s for s in scored if s[4] != label and low * -score <= 100 * -s[0] <= high * -score]
            for rank, s in enumerate(near[:limit], 1):
                found.append((anchor, positive, rank, s[3], -score, -s[0]))
    return sorted(found, key=str)


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, None if v is None else [None if x is None else float(x) for x in v], label, 1, "c", 2) for i, v, label in rows],
        SCHEMA,
    ).repartition(4)


def mined(df, **settings):
    got = negatives.hard_negatives(df, is_anchor=lambda i: i % 100 == 0, **settings)
    return sorted((tuple(r) for r in got.collect()), key=str)


def cones(n, seed, width=12):
    """Rows in a few dense cones, as float32, with labels that cut across them."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, width))
    place = rng.integers(0, 4, n)
    place[: n // 3] = 0
    vectors = (centres[place] + 0.25 * rng.standard_normal((n, width))) * rng.uniform(0.2, 3, (n, 1))
    return [(i, v.astype(np.float32).tolist(), int(rng.integers(0, 3))) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("sizes", [{"block": 50, "anchor_block": 3}, {}])
def test_equals_all_pairs(spark, sizes):
    rows = cones(700, 4)
    assert mined(frame(spark, rows), **sizes) == all_pairs(rows)


def test_odd_rows(spark):
    rows = cones(60, 9, width=3)
    rows += [(100, [0.0, 0.0, 0.0], 1), (200, [1.0, 2.0], 1), (201, [1.0, 2.0], 1), (202, [1.0, 1.0], 2)]
    rows += [(300, [], 1), (301, [], 1), (302, [], 2), (400, [float("nan"), 1.0, 1.0], 1), (500, None, 1)]
    rows += [(600, [1.0, None, 1.0], 1), (700, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1)]
    rows += [(800, [3e30, 1.0, 1.0], 1), (900, [2e6, -1e6, 3e6], 0), (901, [1e6, 1e6, 1e6], 0), (902, [9e5, 1e6, 8e5], 2)]
    rows += [(1000, [1.0, 0.5, 0.25], 2)] * 2 + [(1001, [1.0, 0.5, 0.25], 0)] * 3 + [(1002, [0.5, 0.5, 0.25], 0)]
    assert mined(frame(spark, rows), block=16, anchor_block=4) == all_pairs(rows)


def test_empty_and_lonely(spark):
    assert mined(frame(spark, [])) == []
    assert mined(frame(spark, [(0, [1.0], 1), (1, [1.0], 2)])) == []


def test_bounds_hold():
    """Every score lies in the bounds of its strip, copies and opposites included."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    vectors = np.floor(rng.standard_normal((300, 8)) * 400)
    vectors[100:150] = vectors[0]
    vectors[150:160] = -vectors[0]
    vectors[160] = 0
    norms = np.sqrt((vectors**2).sum(axis=1))
    directions = vectors[:16] / norms[:16, None]
    cosines = np.divide(vectors, norms[:, None], out=np.zeros_like(vectors), where=norms[:, None] > 0) @ directions.T
    angles = np.arccos(np.clip(cosines, -1, 1))
    listed = lambda m: pa.ListArray.from_arrays(
        np.arange(len(m) + 1, dtype=np.int32) * m.shape[1], pa.array(m.ravel())
    )
    rows = pa.RecordBatch.from_arrays(
        [pa.array(range(300)), pa.array(range(300)), pa.array([0] * 300), listed(vectors), listed(angles), pa.array(norms**2)],
        names=["row_no", "id", "label", "vector", "angles", "norm2"],
    )
    block = negatives.Block(rows, np.arange(300))
    cuts, low, high, longest = block.strips()
    lower, upper = negatives.bounds(block, low, high, longest)
    for s, strip in enumerate(cuts):
        got = negatives.scores(block, np.arange(300), block, strip)
        assert (got >= lower[:, s : s + 1]).all() and (got <= upper[:, s : s + 1]).all()
    apart = norms[:, None] * longest
    assert (upper < 0.9 * apart).any() and (lower > -0.9 * apart).any()  # something is cut


def test_relabel(spark):
    rows = cones(300, 6)
    moved = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    change = lambda i, label: F.when(i % 7 == 0, (label + 1) % 10).otherwise(label)
    assert mined(frame(spark, rows), relabel=change) == all_pairs(moved)
