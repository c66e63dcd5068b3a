"""Scan, sink and layer queries. Files go to the session's shared folder."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import Window
from pyspark.sql import functions as F

from larder.functions import exact_sum
from larder.operators import drift, gold, quality
from larder.plans.drift_queries import CUTOFF, SHARE
from larder.plans.pipeline import Pipeline, write_reports
from larder.plans.registry import isum, msum, query, r
from larder.schemas import RAW_TABLES
from larder.session import fresh_path, shuffles_removed, side_by_side, stage
from larder.sources import layers, reconcile

ORDERS = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp, o_orderpriority string"
)


@query(
    "parquet_scan",
    "IO1",
    f"""SELECT o_orderstatus, COUNT(*) AS orders, {msum("o_totalprice")} AS total
    FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY o_orderstatus""",
)
def _(w):
    orders = layers.scan(w.spark, f"{w.folder}/orders.parquet", ORDERS)
    recent = orders.where(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp"))
    return recent.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), exact_sum("o_totalprice").alias("total")
    )


@query(
    "partitioned_scan",
    "IO2",
    f"""SELECT month(date) AS month, COUNT(*) AS lines, {isum("units_sold")} AS units
    FROM sales_line WHERE year(date) = 1999 GROUP BY 1""",
)
def _(w):
    lake = layers.Layer(w.spark, fresh_path(w.spark, "lake"))
    rows = w.line.select("date", "store_id", "sku", "units_sold")
    lake.write_by_date("sales", rows, F.col("date"))
    year = lake.read("sales").where("_year = 1999")
    return year.groupBy(F.col("_month").alias("month")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("units_sold").alias("units")
    )


@query(
    "parsed_dates",
    "IO3",
    """SELECT year(d) AS year, COUNT(*) AS lines, COUNT(d) AS parsed
    FROM (SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS d FROM lineitem)
    GROUP BY 1""",
)
def _(w):
    # Dates as text, unreadable on every seventh line.
    text = w.table("lineitem").selectExpr(
        """CASE WHEN l_linenumber = 7 THEN 'n/a'
           ELSE date_format(l_shipdate, 'yyyy-MM-dd') END AS l_shipdate"""
    )
    parsed = layers.parse_dates(text, ["l_shipdate"])
    return parsed.groupBy(F.year("l_shipdate").alias("year")).agg(
        F.count(F.lit(1)).alias("lines"), F.count("l_shipdate").alias("parsed")
    )


@query(
    "source_files",
    "IO4 F12",
    "SELECT 'lineitem.parquet' AS source_file, COUNT(*) AS rows, COUNT(*) AS stamped FROM lineitem",
)
def _(w):
    rows = layers.with_ingest_metadata(w.table("lineitem"))
    name = F.element_at(F.split("_source_file", "/"), -1)
    return rows.groupBy(name.alias("source_file")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("_loaded_at").alias("stamped")
    )


@query(
    "overwrite_with_new_schema",
    "IO5 IO6",
    "SELECT p_partkey AS sku, p_brand AS brand, p_size * 2 AS double_size FROM part",
)
def _(w):
    lake = layers.Layer(w.spark, fresh_path(w.spark, "lake"))
    part = w.table("part")
    lake.write("part", part)
    changed = part.selectExpr("p_partkey AS sku", "p_brand AS brand", "p_size * 2 AS double_size")
    lake.write("part", changed)
    return lake.read("part")


INGESTED = ("region", "nation", "supplier", "customer", "part", "orders", "carriers")


@query(
    "ingested_tables",
    "IO7 IO8",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", COUNT(*) AS row_count, 'ok' AS status FROM {t}"""
        for t in INGESTED[:-1]
    )
    + " UNION ALL SELECT 'carriers', 0, 'missing'",
)
def _(w):
    raw = layers.Layer(w.spark, w.folder)
    bronze = layers.Layer(w.spark, fresh_path(w.spark, "bronze"))
    written = layers.ingest(raw, bronze, INGESTED)
    tables = {t: None if n is None else bronze.read(t) for t, n in written.items()}
    return layers.row_counts(tables)


@query(
    "created_table",
    "IO9",
    f"""SELECT store_id, COUNT(*) AS lines, {isum("units_sold")} AS units FROM sales_line
    GROUP BY store_id""",
)
def _(w):
    summed = w.line.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("units_sold").alias("units")
    )
    name = f"larder_store_units_{uuid.uuid4().hex}"  # runs side by side do not meet
    return layers.create_table(summed, name, fresh_path(w.spark, "table"))


@query(
    "csv_round_trip",
    "IO10 IO11",
    f"""SELECT date, COUNT(*) AS lines, {msum("revenue")} AS revenue FROM sales_line GROUP BY date""",
)
def _(w):
    path = fresh_path(w.spark, "csv")
    totals = w.line.groupBy("date").agg(
        F.count(F.lit(1)).alias("lines"), exact_sum("revenue").alias("revenue")
    )
    layers.write_csv(totals, path)
    return layers.read_csv(w.spark, path, "date date, lines bigint, revenue double")


@query(
    "json_round_trip",
    "IO12",
    f"""SELECT category, COUNT(*) AS products, MIN(unit_price) AS low, MAX(unit_price) AS high
    FROM products GROUP BY category""",
)
def _(w):
    path = fresh_path(w.spark, "json")
    nested = w.products().groupBy("category").agg(
        F.count(F.lit(1)).alias("products"),
        F.struct(F.min("unit_price").alias("low"), F.max("unit_price").alias("high")).alias("price"),
    )
    layers.write_json(nested, path)
    schema = "category string, products bigint, price struct<low: double, high: double>"
    found = layers.read_json(w.spark, path, schema)
    return found.select("category", "products", "price.low", "price.high")


# A series has feature rows from its eighth day on.
SERIES_ROWS = """(SELECT * FROM (SELECT row_number() OVER (PARTITION BY sku, store_id ORDER BY date)
  AS day FROM (SELECT DISTINCT sku, store_id, date FROM stg_sales)) WHERE day > 7)"""

LAKE_TABLES = {
    "bronze.sales": "sales_line",
    "bronze.products": "products",
    "bronze.suppliers": "suppliers",
    "bronze.inventory": "inventory",
    "bronze.locations": "locations",
    "bronze.purchase_orders": "purchase_orders",
    "bronze.shipments": "shipments",
    "bronze.supplier_product_map": "supplier_map",
    "silver.stg_sales": "stg_sales",
    "silver.stg_products": "products",
    "silver.stg_suppliers": "suppliers",
    "silver.stg_inventory": "stg_inventory",
    "gold.fct_weekly_sales": "(SELECT DISTINCT week_start, store_id, sku FROM stg_sales)",
    "gold.fct_monthly_sales": "monthly_gold",
    "gold.dim_product_performance": "performance_gold",
    "gold.demand_features": SERIES_ROWS,
    "gold.isolation_scores": SERIES_ROWS,
    "gold.anomalies": SERIES_ROWS,
}
# Each raw table has a row for whether it is there; rules count where their tables are.
ABSENT = ("carriers", "demand_forecasts", "production_orders")
CHECKS = len(RAW_TABLES) + sum(rule.table not in ABSENT for rule in quality.RAW_RULES)


def _raw_folder(w) -> str:
    """Every raw table that the order book has, as files in a folder."""
    raw = layers.Layer(w.spark, fresh_path(w.spark, "raw"))
    tables = {
        "sales": w.line,
        "products": w.products(),
        "suppliers": w.suppliers(),
        "inventory": w.inventory(),
        "locations": w.locations(),
        "purchase_orders": w.purchase_orders(),
        "shipments": w.shipments(),
        "supplier_product_map": w.supplier_product_map(),
    }
    ordered = {name: layers.in_file_order(df, name) for name, df in tables.items()}
    with shuffles_removed(w.spark):
        side_by_side(w.spark, [partial(raw.write, name, df) for name, df in ordered.items()])
    return raw.root


@query(
    "layered_pipeline",
    "IO13",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", COUNT(*) AS row_count FROM {source}"""
        for t, source in LAKE_TABLES.items()
    )
    + f" UNION ALL SELECT 'bronze._quality', {CHECKS}",
)
def _(w):
    # All six stages, from a raw folder. These tables break some rules, which are recorded.
    pipeline = Pipeline(w.spark, fresh_path(w.spark, "lake"), _raw_folder(w), strict=False)
    pipeline.run()
    written = {
        t: pipeline.layers[t.split(".")[0]].read(t.split(".")[1])
        for t, n in pipeline.written.items()
        if n is not None
    }
    return layers.row_counts(written).drop("status")


@query(
    "stage_ledger",
    "IO13",
    """SELECT * FROM (VALUES (1, 1, 'bronze', 'done'), (1, 2, 'silver', 'failed'), (2, 1, 'bronze', 'skipped'),
      (2, 2, 'silver', 'done'), (2, 3, 'gold', 'done'), (3, 1, 'bronze', 'skipped'),
      (3, 2, 'silver', 'skipped'), (3, 3, 'gold', 'skipped')) AS t(run, step, stage, state)
    WHERE (SELECT COUNT(*) FROM lineitem) > 0""",
)
def _(w):
    # A run that fails in its second stage, the one that goes on from there, and an idle one.
    pipeline = Pipeline(w.spark, fresh_path(w.spark, "lake"), _raw_folder(w), strict=False)
    stages = ("bronze", "silver", "gold")
    silver, pipeline.silver = pipeline.silver, _fail
    try:
        pipeline.resume(stages)
    except InterruptedError:
        pipeline.silver = silver
    pipeline.resume(stages)
    pipeline.resume(stages)
    ledger = pipeline.ledger.table()
    order = Window.partitionBy().orderBy("first")  # a row per run
    runs = ledger.groupBy("run").agg(F.min("started").alias("first"))
    numbered = runs.select(F.col("run").alias("id"), F.row_number().over(order).alias("run"))
    return ledger.withColumnRenamed("run", "id").join(numbered, "id").select(
        "run", F.col("step").cast("int").alias("step"), "stage", "state"
    )


def _fail():
    raise InterruptedError("an executor was lost")


@query(
    "anomaly_report_files",
    "IO10 IO11",
    """SELECT ds, sku, store_id, units_sold, demand, anomaly_score, day.total_records, day.anomaly_count
    FROM anomalies a JOIN (SELECT ds AS date, COUNT(*) AS total_records,
      CAST(SUM(is_anomaly) AS BIGINT) AS anomaly_count FROM anomalies GROUP BY ds) day ON a.ds = day.date
    WHERE is_anomaly = 1""",
)
def _(w):
    # The report of the pipeline, read back: flagged rows beside the counts of their days.
    folder = fresh_path(w.spark, "reports")
    table = stage(w.anomalies, "anomalies")
    write_reports(table, folder)
    flagged = layers.read_csv(w.spark, f"{folder}/anomalies_flagged", table.schema)
    days = layers.read_csv(
        w.spark, f"{folder}/anomalies_by_date", "date date, total_records bigint, anomaly_count bigint"
    )
    wanted = ("ds", "sku", "store_id", "units_sold", "demand", "anomaly_score")
    return flagged.join(days, flagged["ds"] == days["date"]).select(*wanted, "total_records", "anomaly_count")


@query(
    "drift_summary_file",
    "IO12 X5",
    f"""SELECT d.*, reference_rows, current_rows, drift_share, dataset_drift
    FROM drift_table d, (SELECT COUNT(*) FILTER (WHERE is_reference) AS reference_rows,
        COUNT(*) FILTER (WHERE is_current) AS current_rows FROM marked),
      (SELECT {r(SHARE, 4)} AS drift_share, {SHARE} > 0.3 AS dataset_drift
       FROM drift_table WHERE feature <> 'units_sold')""",
)
def _(w):
    # The nested summary as a file, read back and laid flat.
    marked = drift.periods(w.features, CUTOFF)
    report = stage(drift.drift_report(marked, exact_rows=0), "drift")
    path = fresh_path(w.spark, "summary")
    layers.write_json(drift.drift_summary(report, drift.period_counts(marked), CUTOFF), path)
    found = layers.read_json(w.spark, path, drift.SUMMARY)
    rest = ("reference_rows", "current_rows", "drift_share", "dataset_drift")
    inputs = found.select(*rest, F.explode("features").alias("feature", "result"))
    target = found.select(*rest, F.lit(drift.TARGET).alias("feature"), F.col("target").alias("result"))
    return inputs.unionByName(target).select("feature", "result.*", *rest)


@query(
    "reconciled_layers",
    "IO14",
    """SELECT 'weekly_units' AS "table", COUNT(*) AS left_rows, COUNT(*) AS right_rows,
      TRUE AS counts_match, TRUE AS content_match
    FROM (SELECT DISTINCT week_start, store_id, sku FROM stg_sales)""",
)
def _(w):
    names = ["week_start", "store_id", "sku", "total_units", "total_demand", "num_days"]
    by_api = gold.weekly_sales(w.stg_sales).select(*names)
    by_sql = w.spark.sql(
        """SELECT CAST(date_trunc('WEEK', date) AS DATE) AS week_start, store_id, sku,
             SUM(units_sold) AS total_units, SUM(demand) AS total_demand, COUNT(*) AS num_days
           FROM {sales} GROUP BY 1, 2, 3""",
        sales=w.line,
    )
    return layers.reconcile({"weekly_units": (by_api, by_sql)})


@query(
    "table_sample",
    "IO15",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity LIMIT 20""",
)
def _(w):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    return layers.sample_rows(w.table("lineitem").select(*order), order, 20)


@query(
    "reconciled_nulls",
    "IO14",
    """SELECT 'swapped' AS "table", COUNT(*) AS left_rows, COUNT(*) AS right_rows,
      TRUE AS counts_match, FALSE AS content_match FROM part""",
)
def _(w):
    # The same values and NULLs, in each other's column: no content match.
    size = F.col("p_size")
    left = w.table("part").select(
        F.when(size % 2 == 0, size).alias("a"), F.when(size % 2 == 1, size).alias("b")
    )
    return layers.reconcile({"swapped": (left, left.select(F.col("b").alias("a"), F.col("a").alias("b")))})


# Planted changes: rows that the newer version lacks, has changed, or has alone.
GONE, PRICED, RENAMED, NEW = "p_partkey % 89 = 3", "p_partkey % 97 = 5", "p_partkey % 83 = 7", "p_partkey % 101 = 9"


@query(
    "reconciled_rows",
    "IO14",
    f"""SELECT p_partkey, CASE WHEN copy THEN 'added' WHEN gone THEN 'removed' ELSE 'changed' END AS change,
      CASE WHEN copy OR gone THEN '' WHEN priced AND renamed THEN 'p_name,p_retailprice'
        WHEN priced THEN 'p_retailprice' ELSE 'p_name' END AS columns
    FROM (SELECT p_partkey, FALSE AS copy, {GONE} AS gone, {PRICED} AS priced, {RENAMED} AS renamed FROM part
      UNION ALL SELECT p_partkey + 1000000000, TRUE, FALSE, FALSE, FALSE FROM part WHERE {NEW})
    WHERE copy OR gone OR priced OR renamed""",
)
def _(w):
    part = w.table("part")
    newer = part.where(f"NOT ({GONE})").withColumns(
        {
            "p_retailprice": F.when(F.expr(PRICED), F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")),
            "p_name": F.when(F.expr(RENAMED), F.lit(None)).otherwise(F.col("p_name")),
        }
    )
    added = part.where(NEW).withColumn("p_partkey", F.col("p_partkey") + 1_000_000_000)
    versions = []
    for label, df in (("old", part), ("new", newer.union(added))):
        version = reconcile.CheckedTable(w.spark, fresh_path(w.spark, label), ["p_partkey"], buckets=64)
        version.write(df)
        versions.append(version)
    found = reconcile.row_differences(*versions)
    return found.select("p_partkey", "change", F.array_join("columns", ",").alias("columns"))


@query(
    "safe_overwrite",
    "IO6 IO5",
    """SELECT p_partkey AS sku, p_brand AS brand, p_size * 2 AS double_size, 2 AS versions FROM part""",
)
def _(w):
    lake = layers.VersionedLayer(w.spark, fresh_path(w.spark, "lake"))
    part = w.table("part")
    lake.write("part", part)
    lake.write("part", part.selectExpr("p_partkey AS sku", "p_brand AS brand", "p_size * 2 AS double_size"))
    count = lake.history("part").agg(F.max("number").alias("versions"))
    return lake.read("part").crossJoin(F.broadcast(count))  # one row
