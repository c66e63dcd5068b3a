"""Sketches, the Bloom filter, incremental features."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larder.operators import features, membership, quality, sketches


def test_merged_periods(spark):
    rows = spark.range(20_000).selectExpr(
        "date_add(DATE '2024-01-01', CAST(id % 30 AS INT)) AS day", "id % 3000 AS key", "CAST(id % 5000 AS DOUBLE) AS v"
    ).union(spark.sql("SELECT CAST(NULL AS DATE), 1L, 1D UNION ALL SELECT DATE '2024-01-03', NULL, NULL"))
    states = sketches.daily_states(rows, "day", ["key"], ["v"])
    assert states.count() == 31
    periods = {"start": ("2024-01-01", "2024-01-10"), "month": ("2024-01-01", "2024-01-31"), "later": ("2025-01-01", "2025-01-02")}
    shares = (0.1, 0.5, 0.99)
    got = {
        r.period: r
        for r in sketches.merged(states, periods)
        .select("period", "rows", sketches.distinct_count("key").alias("keys"), sketches.quantiles("v", shares).alias("q"))
        .collect()
    }
    assert set(got) == {"start", "month"}
    for name, r in got.items():
        first, last = periods[name]
        part = rows.where(F.col("day").between(first, last))
        exact = part.agg(F.count_distinct("key")).first()[0]
        assert r["rows"] == part.count()
        assert abs(r["keys"] - exact) <= exact * sketches.COUNT_ERROR
        total = part.agg(F.count("v")).first()[0]
        for share, value in zip(shares, r["q"]):
            low, high = part.agg(F.count_if(F.col("v") < value), F.count_if(F.col("v") <= value)).first()
            assert low / total <= share + sketches.RANK_ERROR and high / total >= share - sketches.RANK_ERROR


@pytest.mark.parametrize("most", [membership.MOST_BYTES, 0])
def test_filtered_anti_join(spark, most):
    child = spark.range(4000).selectExpr("CASE WHEN id % 50 = 0 THEN NULL WHEN id % 3 = 0 THEN 7 ELSE id END AS k")
    parent = spark.range(0, 3000, 2).selectExpr("id AS pk").union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    found, facts = membership.anti_join(child, "k", parent, "pk", most)
    want = quality.orphan_keys(child, "k", parent, "pk")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    row = facts.first()
    assert row.by_filter == (most > 0)
    assert row.ruled_out + row.compared == row.keys and row.orphans == want.count()
    if most:  # few keys without a parent are not ruled out
        assert row.ruled_out >= 0.95 * row.orphans


def test_filter_of_nothing(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k bigint")
    found, facts = membership.anti_join(child, "k", child.where("false"), "k")
    assert sorted(map(tuple, found.collect())) == [(1, 2), (2, 1)]
    assert facts.first().compared == 0
    found, _ = membership.anti_join(child, "k", child, "k")
    assert found.count() == 0


def daily(spark, days):
    rows = [
        (f"k{k}", s, dt.date(2024, 1, 1) + dt.timedelta(d), (d * 7 + s + k) % 13, (d * 5 + k) % 17, 1.0 * d, d % 3 == 0, False)
        for d in range(days) for s in range(2) for k in range(3)
        if (d + k) % 9 or d < 3
    ]
    schema = "sku string, store_id int, ds date, units_sold bigint, demand bigint, revenue double, is_promo boolean, stockout_flag boolean"
    return spark.createDataFrame(rows, schema)


def test_state_and_days_equal_a_rebuild(spark):
    table = daily(spark, 80)
    whole = features.demand_features(table)
    state, parts = features.feature_state(table.where("false")), []
    for first, last in (("2024-01-01", "2024-01-04"), ("2024-01-05", "2024-02-25"), ("2024-02-26", "2024-12-31")):
        built, state = features.new_features(state, table.where(f"ds BETWEEN '{first}' AND '{last}'"))
        parts.append(built.collect())
    got = sorted(tuple(r[c] for c in whole.columns) for p in parts for r in p)
    want = sorted(map(tuple, whole.collect()))
    assert len(got) == len(want)
    assert all(a == pytest.approx(b) for a, b in zip(got, want))
    assert state.groupBy("sku", "store_id").count().agg(F.max("count")).first()[0] == 30


def test_late_rows_are_refused(spark):
    table = daily(spark, 20)
    state = features.feature_state(table.where("ds <= '2024-01-10'"))
    with pytest.raises(ValueError, match="at or before"):
        features.new_features(state, table.where("ds >= '2024-01-10'"))
