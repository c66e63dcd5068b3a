import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import anomalies, isolation


def test_iqr_and_zscore_on_a_known_outlier(spark):
    values = [10, 11, 10, 12, 11, 10] * 5
    for extra, hits in (([], 0), ([100], 1)):
        df = spark.createDataFrame([(float(v),) for v in values + extra], "x double")
        stats = anomalies.global_stats(df, ["x"])
        row = anomalies.outlier_counts(df, ["x"], stats).first()
        assert (row.zscore_outliers, row.iqr_outliers) == (hits, hits)


def _flagged(spark, **kwargs):
    rows = [
        (dt.date(2024, 1, 1), "a", 1, 0, 3, 0.0, None, 5.0, 0.0),
        (dt.date(2024, 1, 2), "a", 1, 10, 10, 5.0, True, 10.0, 2.0),
    ]
    df = spark.createDataFrame(
        rows,
        "ds date, sku string, store_id int, units_sold bigint, demand bigint, revenue double,"
        " stockout_flag boolean, units_sold_roll_mean_7 double, units_sold_roll_std_7 double",
    )
    stats = anomalies.global_stats(df)
    return anomalies.flag_anomalies(df, stats, **kwargs).orderBy("ds").collect()


def test_zero_divisors_divide_by_one_by_default(spark):
    first, second = _flagged(spark)
    assert (first.demand_deviation, first.lost_sales_ratio) == (-5.0, 2.0)
    assert (first.anomaly_demand_contextual, first.anomaly_high_lost_sales) == (1, 1)
    assert (first.anomaly_stockout, first.anomaly_score, first.is_anomaly) == (0, 2, 1)
    assert (second.anomaly_stockout, second.anomaly_score, second.is_anomaly) == (1, 1, 0)


def test_zero_divisors_can_be_unknown(spark):
    first, _ = _flagged(spark, zero_divisor="null")
    assert first.demand_deviation is None and first.lost_sales_ratio is None
    assert (first.anomaly_demand_contextual, first.anomaly_score) == (0, 0)


def test_duplicate_isolation_rows_do_not_fan_out(spark):
    keys = [(dt.date(2024, 1, 2), "a", 1, 1)] * 3
    flags = spark.createDataFrame(
        keys, f"ds date, sku string, store_id int, {anomalies.ISOLATION} int"
    )
    rows = _flagged(spark, isolation=flags)
    assert len(rows) == 2
    assert [r[anomalies.ISOLATION] for r in rows] == [0, 1]


def test_context_has_the_window_and_the_baseline(spark):
    rows = [
        (dt.date(2024, 1, d), "a", 1, d, d, float(d), 2 if d == 10 else 0, int(d == 10))
        + (0,) * len(anomalies.FLAGS)
        for d in range(1, 15)
        if d != 8
    ]
    schema = (
        "ds date, sku string, store_id int, units_sold bigint, demand bigint, revenue double,"
        " anomaly_score int, is_anomaly int, " + ", ".join(f"{f} int" for f in anomalies.FLAGS)
    )
    table = spark.createDataFrame(rows, schema)
    row = anomalies.anomaly_context(table).first()
    assert [h.ds.day for h in row.history] == [3, 4, 5, 6, 7, 9, 10, 11]
    assert row.avg_units == pytest.approx(np.mean([d for d in range(1, 15) if d != 8]))
    events = table.where("is_anomaly = 1")
    near = anomalies.nearby_history(events, table.select("sku", "store_id", "ds", "units_sold"))
    assert sorted(r.ds.day for r in near.collect()) == [3, 4, 5, 6, 7, 9, 10, 11]


# -- isolation forest ----------------------------------------------------------


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(2000, 2))
    points[:20] += 12
    rows = [
        (dt.date(2020, 1, 1) + dt.timedelta(i % 900), f"s{i}", 1, float(a), float(b), i < 20)
        for i, (a, b) in enumerate(points)
    ]
    return spark.createDataFrame(
        rows, "ds date, sku string, store_id int, a double, b double, odd boolean"
    )


def test_forest_finds_the_far_points(cloud):
    forest = isolation.fit_isolation_forest(cloud, ("a", "b"), trees=50)
    flags = isolation.isolation_flags(forest.score(cloud), contamination=0.05)
    assert flags.where("odd").agg(F.avg(anomalies.ISOLATION)).first()[0] == 1.0
    share = flags.agg(F.avg(anomalies.ISOLATION)).first()[0]
    assert 0.0 < share <= 0.05


def test_forest_does_not_depend_on_partitioning(cloud):
    one = isolation.fit_isolation_forest(cloud.repartition(1), ("a", "b"), trees=5)
    many = isolation.fit_isolation_forest(cloud.repartition(9), ("a", "b"), trees=5)
    key = ["tree", "node"]
    a = one.nodes.sort_values(key).reset_index(drop=True)
    b = many.nodes.sort_values(key).reset_index(drop=True)
    assert a.equals(b)


def test_samples_are_bounded(cloud):
    samples = isolation.draw_samples(cloud.select("ds", "sku", "store_id", "a"), 10, 64, 7)
    sizes = [r["count"] for r in samples.groupBy("tree").count().collect()]
    assert sizes == [64] * 10


def test_forest_on_constant_data(spark, cloud):
    flat = cloud.withColumn("a", F.lit(1.0)).withColumn("b", F.lit(2.0))
    forest = isolation.fit_isolation_forest(flat, ("a", "b"), trees=3)
    flags = isolation.isolation_flags(forest.score(flat))
    assert flags.agg(F.sum(anomalies.ISOLATION)).first()[0] == 0


def test_splits_between_neighbouring_floats_are_never_empty():
    low = 1.0
    values = np.array([[low], [np.nextafter(low, 2)]] * 4)
    for seed in range(20):
        nodes = isolation._grow(values, 3, np.random.default_rng(seed))
        assert len(nodes) == 3
