import datetime as dt
import threading
import time

import pytest
from pyspark.sql import functions as F

from larder import schemas, session
from larder.operators import features, gold, staging
from larder.plans.pipeline import Pipeline, chosen_stages
from larder.session import fresh_path, shared_dir
from larder.sources import layers


@pytest.fixture
def lake(spark):
    return fresh_path(spark, "test-lake")


def frame(spark, table, rows):
    return spark.createDataFrame(rows, schemas.raw_schema(table))


@pytest.fixture(scope="module")
def raw(spark):
    """A small raw folder with the text dates a file export may contain."""
    start = dt.datetime(2024, 1, 1)
    path = fresh_path(spark, "test-raw")
    sales = [
        (start + dt.timedelta(d), f"ST{s}", f"SKU{k}", (d * 7 + s + k) % 11,
         (d * 7 + s + k) % 11 + d % 2, float((d * 7 + s + k) % 11) * 2, d % 5 == 0, d % 9 == 0)
        for d in range(60) for s in range(2) for k in range(3)
    ]
    tables = {
        "sales": frame(spark, "sales", sales).withColumn(
            "date", F.date_format("date", "yyyy-MM-dd HH:mm:ss")
        ),
        "products": frame(
            spark, "products",
            [(f"SKU{k}", f"p{k}", "c", 1.0, 0.5, None, False, "ABC"[k], 2.0, 3) for k in range(3)],
        ),
        "suppliers": frame(
            spark, "suppliers", [(f"SUP{i}", "s", "r", 5, 1, 0.9, 1.0, 10, 30) for i in range(3)]
        ),
        "inventory": frame(
            spark, "inventory",
            [(start, "ST0", f"SKU{k}", k * 40, 5, None, 9.0) for k in range(3)],
        ),
    }
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}")
    return path


def test_whole_pipeline(spark, lake, raw):
    run = Pipeline(spark, lake, raw)
    written = run.run(("bronze", "silver", "gold", "features", "anomalies"))
    assert written["bronze.carriers"] is None
    assert written["silver.stg_sales"] == 360
    assert written["gold.demand_features"] == 6 * (60 - 7)
    assert written["gold.anomalies"] == 6 * (60 - 7)
    sold = run.layers["silver"].read("stg_sales").agg(F.sum("units_sold")).first()[0]
    weekly = run.layers["gold"].read("fct_weekly_sales").agg(F.sum("total_units")).first()[0]
    assert sold == weekly
    assert run.summary().where("table = 'silver.stg_sales'").first().row_count == 360


def test_failed_check_stops_the_run(spark, lake, raw):
    run = Pipeline(spark, lake, raw)
    with pytest.raises(RuntimeError, match="quality rules failed"):
        run.run(("bronze", "check", "silver"))
    assert not run.layers["silver"].exists("stg_sales")
    stored = run.layers["bronze"].read("_quality")
    assert stored.where("check = 'min_rows' AND table = 'sales'").first().passed is False


def test_stage_flags():
    import argparse

    def stages(**on):
        base = {"skip_bronze": False, "silver_only": False, "gold_only": False}
        return chosen_stages(argparse.Namespace(**{**base, **on}))

    assert stages()[0] == "bronze"
    assert stages(skip_bronze=True)[0] == "silver"
    assert stages(silver_only=True) == ("silver",)
    assert stages(gold_only=True) == ("gold",)


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([("2024-01-05",), ("soon",), (None,)], "d string")
    got = [r.d for r in layers.parse_dates(df, ["d"]).collect()]
    assert got == [dt.datetime(2024, 1, 5), None, None]


def test_write_counts_without_a_second_job(spark, lake):
    layer = layers.Layer(spark, lake)
    assert layer.write("t", spark.range(7)) == 7
    assert layer.read("t").count() == 7


def test_dated_tables_prune_partitions(spark, lake):
    layer = layers.Layer(spark, lake)
    df = spark.sql("SELECT explode(sequence(date'2023-01-01', date'2024-12-31')) AS ds")
    layer.write_by_date("t", df, F.col("ds"))
    year = layer.read("t").where("_year = 2024 AND _month = 2")
    assert year.count() == 29
    plan = year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_year" in plan


def test_scan_pushes_filters_and_columns(spark, workspace):
    rows = workspace.table("lineitem").where("l_quantity > 49").select("l_partkey", "l_quantity")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,49.0)" in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan


def test_reconcile_sees_counts_and_content(spark):
    a, b = spark.range(5), spark.range(1, 6)
    rows = {r.table: r for r in layers.reconcile({"same": (a, a), "other": (a, b)}).collect()}
    assert rows["same"].content_match and rows["same"].counts_match
    assert rows["other"].counts_match and not rows["other"].content_match


def test_conform_casts_and_reports_missing(spark):
    df = spark.createDataFrame(
        [("1", "x", "s", "r", "30", "x", "0.9", "1", "5", "7")],
        "supplier_id string, extra string, supplier_name string, region string,"
        " lead_time_days string, lead_time_std string, reliability_score string,"
        " unit_cost_multiplier string, min_order_qty string, payment_terms_days string",
    )
    row = schemas.conform(df, "suppliers").first()
    assert (row.lead_time_days, row.lead_time_std, row.extra) == (30, None, "x")
    with pytest.raises(ValueError, match="region"):
        schemas.conform(df.drop("region"), "suppliers")


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == shared_dir(spark)
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


def test_gold_on_zero_demand(spark):
    rows = [(dt.datetime(2024, 1, 1), "ST0", "SKU0", 0, 0, 0.0, False, True)]
    weekly = gold.weekly_sales(staging.stage_sales(frame(spark, "sales", rows))).first()
    assert weekly.fill_rate is None and weekly.lost_sales_pct is None
    assert (weekly.total_units, weekly.stockout_days, weekly.avg_daily_revenue) == (0, 1, 0.0)


def test_no_stored_file_is_left_after_a_query(spark):
    """Runs in a shared folder of its own, which other tests do not read."""
    from pathlib import Path

    from larder import session
    from larder.plans.catalog import QUERIES

    before = session.shared_dir(spark)
    own = f"{before}/own"
    spark.sparkContext.setCheckpointDir(own)
    try:
        rows = QUERIES["psi"].run(spark, "/root/testdata/sf0.001").collect()
        folder = Path(session.shared_dir(spark).removeprefix("file:")) / "larder"
        assert len(rows) == 13 and any(folder.iterdir())
        session.clear_stages(spark)
        assert not folder.exists()
    finally:
        spark.sparkContext.setCheckpointDir(before)


def test_sales_are_moved_once_for_gold_and_features(spark, lake, raw):
    run = Pipeline(spark, lake, raw)
    run.run(("bronze", "silver"))
    sales = staging.stage_sales(run.sales_by_series())
    try:
        for df in (gold.weekly_sales(sales), gold.monthly_sales(sales), features.daily_grain(sales)):
            df.collect()  # the plan that ran, down to the kept sales
            plan = df._jdf.queryExecution().executedPlan().toString()
            ran = plan.split("== Initial Plan ==")[0].split("InMemoryRelation")
            assert len(ran) > 1 and "Exchange" not in ran[0]
        stored = run.layers["silver"].read("stg_sales")
        assert gold.weekly_sales(sales).exceptAll(gold.weekly_sales(stored)).isEmpty()
        assert gold.monthly_sales(sales).exceptAll(gold.monthly_sales(stored)).isEmpty()
    finally:
        run.release()
    assert run._by_series is None


def test_rows_without_a_key_are_no_history(spark):
    start = dt.date(2024, 1, 1)
    rows = [("a", 1, start + dt.timedelta(d), d, d, 1.0, False, False) for d in range(10)]
    rows += [("a", 1, None, 99, 99, 1.0, False, False), (None, 1, start, 5, 5, 1.0, False, False)]
    rows += [("a", None, start + dt.timedelta(7), 30, 30, 1.0, False, False)]
    daily = spark.createDataFrame(
        rows,
        "sku string, store_id int, ds date, units_sold bigint, demand bigint, revenue double,"
        " is_promo boolean, stockout_flag boolean",
    )
    got = {r.ds.day: r for r in features.demand_features(daily).collect()}
    assert sorted(got) == [8, 9, 10]
    assert [got[d].units_sold_lag_7 for d in (8, 9, 10)] == [0, 1, 2]
    assert (got[8].sku_total_qty, got[8].store_total_qty) == (37, 7)


def test_raw_tables_are_loaded_side_by_side(spark, lake, raw, monkeypatch):
    meet = threading.Barrier(4)  # broken, if a table waits for another one to be written
    write = layers.Layer.write

    def met(self, *args):
        meet.wait(60)
        return write(self, *args)

    monkeypatch.setattr(layers.Layer, "write", met)
    counts = layers.ingest(layers.Layer(spark, raw), layers.Layer(spark, lake))
    assert list(counts) == list(schemas.RAW_TABLES)
    assert (counts["sales"], counts["products"], counts["carriers"]) == (360, 3, None)


def test_bronze_files_are_in_order_of_days(spark, lake):
    days = [dt.datetime(2024, 1, 1) + dt.timedelta(d) for d in (5, 1, 9, 1, 7, 3)]
    rows = [(day, "ST0", f"SKU{i % 2}", i, i, 1.0, False, False) for i, day in enumerate([*days, None])]
    raw = layers.Layer(spark, f"{lake}/unordered")
    raw.write("sales", frame(spark, "sales", rows).coalesce(1))
    bronze = layers.Layer(spark, f"{lake}/ordered")
    layers.ingest(raw, bronze, ["sales", "products"])
    stored = bronze.read("sales")
    assert stored.drop("_loaded_at", "_source_file").exceptAll(raw.read("sales")).isEmpty()
    assert stored.count() == 7
    part = stored.select(F.monotonically_increasing_id().alias("place"), "date", "sku").orderBy("place")
    found = [(r.date or dt.datetime.min, r.sku) for r in part.collect()]
    assert found == sorted(found)


def test_shuffled_files_go_with_their_query(spark, lake):
    def shuffled():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        names = disk.getAllFiles().mkString("\n").split("\n")
        return {n for n in names if "/shuffle_" in n}

    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = shuffled()
    with session.shuffles_removed(spark):
        assert layers.Layer(spark, lake).write("sums", df) == 7
        for _ in range(50):  # files are removed on the side
            if shuffled() <= before:
                break
            time.sleep(0.1)
        assert shuffled() <= before
    layers.Layer(spark, lake).write("sums", df)
    assert shuffled() - before  # as elsewhere, until the frame is garbage


def test_the_pipeline_keeps_no_shuffled_files(spark, lake, raw):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(name), []
    run = Pipeline(spark, f"{lake}/own", raw)
    run._work = lambda stage: lambda: seen.append(spark.conf.get(name))
    run.run(("bronze", "silver"))
    assert seen == ["true", "true"] and spark.conf.get(name) == before
    run.resume(("bronze",))
    assert seen == ["true"] * 3 and spark.conf.get(name) == before


def test_shipped_lines_are_moved_for_one_join(spark, workspace):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        plan = workspace.shipments()._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(name, before)
    lines = plan.split("\n")
    # Customers are joined below the join that lines take part in.
    depth = {key: min(len(x) - len(x.lstrip(" :+-")) for x in lines if "Join Inner" in x and key in x)
             for key in ("l_orderkey", "o_custkey")}
    assert depth["o_custkey"] > depth["l_orderkey"]
