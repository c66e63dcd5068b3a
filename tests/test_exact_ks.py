from itertools import combinations
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import drift


def enumerated(reached, n, m):
    """Share of all orders of n and m values whose distance is at least reached / (n m)."""
    hits = 0
    for places in combinations(range(n + m), n):
        i = j = far = 0
        chosen = set(places)
        for k in range(n + m):
            i, j = (i + 1, j) if k in chosen else (i, j + 1)
            far = max(far, abs(i * m - j * n))
        hits += far >= reached
    return hits / comb(n + m, n)


@pytest.mark.parametrize("n,m", [(1, 1), (3, 5), (5, 5), (6, 4), (7, 6), (2, 9)])
def test_equals_enumeration(n, m):
    for reached in {1, n, m, n * m // 2, n * m - 1, n * m}:
        got = drift.exact_p_value(reached / (n * m), n, m)
        assert got == pytest.approx(enumerated(reached, n, m), abs=1e-12)


def test_small_chances_do_not_cancel():
    assert drift.exact_p_value(1.0, 20, 30) == pytest.approx(2 / comb(50, 20), rel=1e-12)
    assert drift.exact_p_value(0.0, 20, 30) == 1.0
    assert np.isnan(drift.exact_p_value(0.5, 0, 3))


def test_large_samples_meet_the_limit():
    n, m = 3000, 2000
    for distance in (0.03, 0.04, 0.06):
        x = distance * (n * m / (n + m)) ** 0.5
        limit = 2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * x * x) for k in range(1, 50))
        assert drift.exact_p_value(distance, n, m) == pytest.approx(limit, rel=0.1)


def test_switch(spark):
    rows = [("small", 0.5, 6, 4), ("large", 0.03, 20_000, 10), ("none", None, 0, 4)]
    df = spark.createDataFrame(rows, "k string, d double, n bigint, m bigint")
    p = drift.ks_p_value(F.col("d"), F.col("n"), F.col("m"))
    slow = drift.asymptotic_p_value(F.col("d"), F.col("n"), F.col("m"))
    got = {r.k: (r.p, r.slow) for r in df.select("k", p.alias("p"), slow.alias("slow")).collect()}
    assert got["small"][0] == pytest.approx(enumerated(12, 6, 4), abs=1e-12)
    assert got["large"][0] == got["large"][1]
    assert got["none"][0] is None


def test_summary_is_whole(spark):
    schema = "feature string, psi double, ks_statistic double, ks_pvalue double, drift_detected boolean"
    report = spark.createDataFrame([("a", 0.3, 0.2, 0.01, True), ("b", None, None, None, None), ("units_sold", 0.1, 0.1, 0.5, False)], schema)
    counts = spark.createDataFrame([(9, 0)], "reference_rows bigint, current_rows bigint")
    row = drift.drift_summary(report, counts, "2024-01-01").first()
    assert set(row.features) == {"a", "b"} and row.features["a"].drift_detected and row.target.psi == 0.1
    assert (row.reference_rows, row.drifted_features, row.drift_share, row.dataset_drift) == (9, 1, 1.0, True)
