"""Staging, gold, join and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import exact_sum, round_to
from larder.operators import (
    anomalies,
    features,
    gold,
    membership,
    quality,
    reports,
    sketches,
    staging,
)
from larder.plans.registry import Workspace, isum, msum, pct, query, r
from larder.plans.views import VOLUME
from larder.session import stage

# -- staging -----------------------------------------------------------------


@query("staged_products", "P1 F9 F13", "SELECT * FROM stg_products")
def _(w: Workspace):
    return w.stg_products


@query(
    "staged_suppliers",
    "P2 F10",
    """SELECT *, CASE WHEN reliability_score >= 0.95 THEN 'Excellent'
      WHEN reliability_score >= 0.85 THEN 'Good' WHEN reliability_score >= 0.70 THEN 'Fair'
      ELSE 'Poor' END AS reliability_tier FROM suppliers""",
)
def _(w):
    return staging.stage_suppliers(w.suppliers())


@query(
    "staged_sales",
    "P3 F1 F2 F3 F4 F6 F7",
    "SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM stg_sales",
)
def _(w):
    return w.stg_sales


@query(
    "staged_inventory",
    "P4",
    "SELECT * REPLACE (CAST(inventory_value AS DOUBLE) AS inventory_value) FROM stg_inventory",
)
def _(w):
    return w.stg_inventory


@query(
    "plausible_sales",
    "P5",
    f"""SELECT month(date) AS month, COUNT(*) AS kept, {isum("units_sold")} AS units
    FROM sales_line WHERE units_sold >= 0 AND revenue >= 0 GROUP BY month(date)""",
)
def _(w):
    kept = staging.plausible_sales(w.line)
    return kept.groupBy(F.month("date").alias("month")).agg(
        F.count(F.lit(1)).alias("kept"), F.sum("units_sold").alias("units")
    )


@query(
    "features_with_history",
    "P6 P7 P8",
    f"""SELECT sku, COUNT(*) AS complete_rows, {isum("units_sold_lag_30")} AS lag_30_total,
      (SELECT COUNT(*) FROM features f WHERE f.sku = g.sku) AS rows_with_history,
      (SELECT COUNT(*) FROM features f WHERE f.sku = g.sku
        AND COALESCE(units_sold_lag_30, 0) = 0) AS zero_rows
    FROM features g WHERE units_sold_lag_30 IS NOT NULL GROUP BY sku""",
)
def _(w):
    history = w.stored("sku", "units_sold_lag_30")
    complete = staging.complete_rows(history, ["units_sold_lag_30"])
    filled = staging.fill_missing(history, ["units_sold_lag_30"])
    kept = complete.groupBy("sku").agg(F.count(F.lit(1)).alias("complete_rows"))
    summed = filled.groupBy("sku").agg(
        F.count(F.lit(1)).alias("rows_with_history"),
        F.sum("units_sold_lag_30").alias("lag_30_total"),
        F.count_if(F.col("units_sold_lag_30") == 0).alias("zero_rows"),
    )
    return kept.join(summed, "sku")


@query(
    "membership",
    "P9",
    f"""SELECT COUNT(*) FILTER (WHERE category IN ('ECONOMY', 'SMALL')) AS inside,
      COUNT(*) FILTER (WHERE category NOT IN ('ECONOMY', 'SMALL')) AS outside,
      {isum("CASE WHEN shelf_life_days NOT IN (7, 14) THEN 1 ELSE 0 END")} AS other_shelf_life
    FROM products""",
)
def _(w):
    chosen = F.col("category").isin("ECONOMY", "SMALL")
    return w.products().agg(
        F.count_if(chosen).alias("inside"),
        F.count_if(~chosen).alias("outside"),
        F.count_if(~F.col("shelf_life_days").isin(7, 14)).alias("other_shelf_life"),
    )


@query(
    "date_slices",
    "P10",
    f"""SELECT CASE WHEN date < DATE '2000-01-01' THEN 'reference' ELSE 'current' END AS period,
      COUNT(*) AS lines, {isum("units_sold")} AS units FROM sales_line
    WHERE date < DATE '2000-01-01' OR date BETWEEN DATE '2000-06-01' AND DATE '2001-06-01'
    GROUP BY 1""",
)
def _(w):
    def summed(df, period):
        return df.agg(F.count(F.lit(1)).alias("lines"), F.sum("units_sold").alias("units")).select(
            F.lit(period).alias("period"), "lines", "units"
        )

    reference = staging.before_date(w.line, "2000-01-01", "date")
    current = staging.between_dates(w.line, "2000-06-01", "2001-06-01", "date")
    return summed(reference, "reference").unionByName(summed(current, "current"))


@query(
    "recent_sales",
    "P11",
    f"""SELECT date, COUNT(*) AS lines, {msum("revenue")} AS revenue FROM sales_line
    WHERE date >= (SELECT MAX(date) - 90 FROM sales_line) GROUP BY date""",
)
def _(w):
    recent = staging.last_days(w.line, 90, "date")
    return recent.groupBy("date").agg(
        F.count(F.lit(1)).alias("lines"), exact_sum("revenue").alias("revenue")
    )


@query(
    "any_flag_rows",
    "P13",
    """SELECT sku, COUNT(*) AS flagged FROM anomalies WHERE anomaly_demand_zscore = 1
      OR anomaly_demand_iqr = 1 OR anomaly_demand_contextual = 1 OR anomaly_revenue_iqr = 1
    GROUP BY sku""",
)
def _(w):
    flags = [
        "anomaly_demand_zscore",
        "anomaly_demand_iqr",
        "anomaly_demand_contextual",
        "anomaly_revenue_iqr",
    ]
    hit = w.anomalies.where(staging.any_flag(flags))
    return hit.groupBy("sku").agg(F.count(F.lit(1)).alias("flagged"))


@query(
    "commercial_columns",
    "P14 J9",
    f"""SELECT category, {msum("s.units_sold * unit_cost")} AS cogs,
      {msum("s.units_sold * unit_price * (1 - l_discount)")} AS net_revenue, COUNT(*) AS lines
    FROM (SELECT l_partkey AS sku, CAST(l_quantity AS BIGINT) AS units_sold, l_discount
      FROM lineitem) s JOIN products p ON s.sku = p.sku GROUP BY category""",
)
def _(w):
    lines = w.table("lineitem").selectExpr(
        "l_partkey AS sku", "CAST(l_quantity AS BIGINT) AS units_sold", "l_discount AS discount"
    )
    priced = staging.with_commercials(lines, w.products(), "discount")
    return (
        priced.join(w.products().select("sku", "category"), "sku")
        .groupBy("category")
        .agg(
            exact_sum("cogs").alias("cogs"),
            exact_sum("net_revenue").alias("net_revenue"),
            F.count(F.lit(1)).alias("lines"),
        )
    )


@query(
    "stock_value_by_location",
    "P14",
    f"""SELECT location_id, {msum("on_hand_qty * unit_cost")} AS stock_value
    FROM inventory i JOIN products p ON i.sku = p.sku GROUP BY location_id""",
)
def _(w):
    valued = staging.with_stock_value(w.inventory(), w.products())
    return valued.groupBy("location_id").agg(exact_sum("inventory_value").alias("stock_value"))


ORDER_STATUS = """SELECT *, CASE WHEN actual_date <= DATE '1999-06-30' THEN 'DELIVERED'
      WHEN order_date <= DATE '1999-06-30' THEN 'IN_TRANSIT' ELSE 'PLANNED' END AS status,
      CASE WHEN actual_date <= DATE '1999-06-30'
        THEN date_diff('day', expected_date, actual_date) END AS delay_days
    FROM purchase_orders"""


@query(
    "order_status",
    "P15",
    f"""SELECT status, COUNT(*) AS orders, COUNT(delay_days) AS with_delay,
      CAST(COALESCE(SUM(delay_days), 0) AS BIGINT) AS total_delay
    FROM ({ORDER_STATUS}) GROUP BY status""",
)
def _(w):
    staged = staging.with_order_status(w.purchase_orders(), "1999-06-30")
    return staged.groupBy("status").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count("delay_days").alias("with_delay"),
        F.coalesce(F.sum("delay_days"), F.lit(0)).alias("total_delay"),
    )


# -- gold --------------------------------------------------------------------


@query(
    "weekly_sales",
    "G1 G5",
    f"""SELECT week_start, store_id, sku, {VOLUME},
      {pct("SUM(lost_sales)", "SUM(demand)")} AS lost_sales_pct,
      {r("AVG(units_sold)", 2)} AS avg_daily_units,
      {r(f"{msum('revenue')} / COUNT(revenue)", 2)} AS avg_daily_revenue, COUNT(*) AS num_days
    FROM stg_sales GROUP BY week_start, store_id, sku""",
)
def _(w):
    return gold.weekly_sales(w.stg_sales)


@query("monthly_sales", "G2", "SELECT * FROM monthly_gold")
def _(w):
    return w.monthly


@query("product_performance", "G3 J1", "SELECT * FROM performance_gold")
def _(w):
    return gold.product_performance(w.stg_products, w.monthly, w.stg_inventory)


@query(
    "daily_sku_sales",
    "G4",
    f"""SELECT date AS ds, sku, {isum("units_sold")} AS total_units,
      {msum("revenue")} AS total_revenue,
      {r("AVG(CAST(revenue AS DOUBLE) / NULLIF(units_sold, 0))", 4)}
        AS avg_price
    FROM sales_line GROUP BY date, sku""",
)
def _(w):
    return gold.daily_sku_sales(w.line)


# -- reports over features ---------------------------------------------------

DAILY = f"""SELECT ds, {msum("revenue")} AS revenue, {isum("units_sold")} AS units_sold,
  COUNT(DISTINCT sku) AS active_skus, COUNT(DISTINCT store_id) AS active_stores
  FROM features GROUP BY ds"""


@query("daily_totals", "G9 G6", DAILY)
def _(w):
    return reports.daily_totals(w.features)


@query(
    "kpi_header",
    "G28",
    f"""SELECT {msum("revenue")} AS total_revenue, {isum("units_sold")} AS total_units,
      {r(msum("revenue") + " / COUNT(revenue)", 4)} AS avg_daily_revenue,
      MAX(active_skus) AS active_skus FROM ({DAILY})""",
)
def _(w):
    return reports.kpi_header(reports.daily_totals(w.features))


@query(
    "top_products",
    "G10 T1 T2",
    f"""SELECT sku, {msum("revenue")} AS total_revenue, {isum("units_sold")} AS total_units,
      {r("AVG(units_sold)", 4)} AS avg_daily_units
    FROM features GROUP BY sku ORDER BY total_revenue DESC, sku LIMIT 20""",
)
def _(w):
    return reports.top_products(w.features)


@query(
    "product_summary",
    "G11",
    f"""SELECT sku, {isum("units_sold")} AS total_units, {r("AVG(units_sold)", 2)} AS avg_daily,
      {r("STDDEV_SAMP(units_sold)", 2)} AS std_dev, {r(msum("revenue"), 2)} AS total_revenue
    FROM features GROUP BY sku""",
)
def _(w):
    return reports.product_summary(w.features)


@query(
    "store_summary",
    "G12",
    f"""SELECT store_id, {isum("units_sold")} AS total_units, {msum("revenue")} AS total_revenue,
      COUNT(DISTINCT sku) AS unique_skus FROM features GROUP BY store_id""",
)
def _(w):
    return reports.store_summary(w.features)


@query(
    "monthly_trend",
    "G13",
    f"""SELECT month_start, {msum("total_revenue")} AS revenue, {isum("total_units")} AS units
    FROM monthly_gold GROUP BY month_start""",
)
def _(w):
    return reports.monthly_trend(w.monthly)


@query(
    "monthly_trend_raw",
    "G13",
    f"""SELECT CAST(date_trunc('month', date) AS DATE) AS month, {r(msum("revenue"), 2)} AS revenue,
      {isum("units_sold")} AS units, COUNT(*) FILTER (WHERE stockout_flag) AS stockout_events
    FROM sales_line GROUP BY 1""",
)
def _(w):
    return reports.monthly_trend_raw(w.line)


@query(
    "revenue_by_category",
    "G14 J3",
    f"""SELECT category, {r(msum("revenue"), 2)} AS total_revenue,
      {isum("units_sold")} AS total_units
    FROM sales_line s JOIN products p ON s.sku = p.sku GROUP BY category
    ORDER BY total_revenue DESC, category LIMIT 10""",
)
def _(w):
    return reports.revenue_by_category(w.line, w.products())


@query(
    "supplier_delays",
    "G15",
    f"""SELECT supplier_id, COUNT(*) AS total_pos, {r("AVG(delay_days)", 1)} AS avg_delay,
      COUNT(*) FILTER (WHERE delay_days > 0) AS delayed_pos
    FROM ({ORDER_STATUS}) WHERE delay_days IS NOT NULL GROUP BY supplier_id
    ORDER BY avg_delay DESC, supplier_id LIMIT 10""",
)
def _(w):
    staged = staging.with_order_status(w.purchase_orders(), "1999-06-30")
    return reports.supplier_delays(staged)


@query(
    "products_by_class",
    "G16",
    "SELECT abc_class, COUNT(*) AS cnt FROM products GROUP BY abc_class",
)
def _(w):
    return reports.products_by_class(w.products())


@query(
    "top_selling",
    "G17",
    f"""SELECT sku, {msum("revenue")} AS total_revenue, {isum("units_sold")} AS total_units,
      COUNT(*) AS transactions FROM sales_line GROUP BY sku
    ORDER BY total_revenue DESC, sku LIMIT 10""",
)
def _(w):
    return reports.top_selling(w.line)


@query(
    "warehouse_overview",
    "G18",
    f"""SELECT COUNT(*) AS total_records, COUNT(DISTINCT sku) AS unique_skus,
      COUNT(DISTINCT store_id) AS unique_stores, MIN(ds) AS date_from, MAX(ds) AS date_to,
      {msum("revenue")} AS total_revenue FROM features""",
)
def _(w):
    return reports.overview(w.features)


RECENT = "ds >= (SELECT MAX(ds) - 30 FROM features)"


@query(
    "period_kpis",
    "G19",
    f"""SELECT {msum("revenue")} AS total_revenue, {isum("units_sold")} AS total_units,
      COUNT(DISTINCT sku) AS active_skus, COUNT(DISTINCT store_id) AS active_stores,
      COUNT(*) AS transactions, {r("AVG(units_sold)", 4)} AS avg_daily_units
    FROM features WHERE {RECENT}""",
)
def _(w):
    return reports.period_kpis(w.sold)


def performers(key: str, direction: str) -> str:
    return f"""SELECT {key}, {msum("revenue")} AS revenue, {isum("units_sold")} AS units
      FROM features WHERE {RECENT} GROUP BY {key} ORDER BY revenue {direction}, {key} LIMIT 5"""


@query("top_performers", "G20", performers("sku", "DESC"))
def _(w):
    return reports.period_performers(w.sold, "sku")


@query("bottom_performers", "G20", performers("sku", "ASC"))
def _(w):
    return reports.period_performers(w.sold, "sku", largest=False)


@query("top_stores", "G20", performers("store_id", "DESC"))
def _(w):
    return reports.period_performers(w.sold, "store_id")


@query(
    "period_trend",
    "G21",
    f"""SELECT ds, {msum("revenue")} AS daily_revenue, {isum("units_sold")} AS daily_units
    FROM features WHERE {RECENT} GROUP BY ds""",
)
def _(w):
    return reports.period_trend(w.sold)


@query(
    "period_anomalies",
    "G22",
    f"""SELECT COUNT(*) AS total_anomalies, COUNT(DISTINCT sku) AS affected_skus
    FROM anomalies WHERE is_anomaly = 1 AND {RECENT}""",
)
def _(w):
    return reports.period_anomalies(w.anomalies)


@query(
    "units_by_weekday",
    "G23",
    f"SELECT day_of_week, {r('AVG(units_sold)', 4)} AS avg_units FROM features GROUP BY day_of_week",
)
def _(w):
    return reports.units_by_weekday(w.features)


@query(
    "revenue_above_threshold",
    "G24",
    f"""SELECT sku, {msum("revenue")} AS revenue FROM sales_line GROUP BY sku
    HAVING SUM(revenue) > 1500000""",
)
def _(w):
    return reports.revenue_above(w.line, 1_500_000)


@query(
    "stores_by_anomaly_rate",
    "G25",
    f"""SELECT store_id, COUNT(*) AS total_records, {isum("is_anomaly")} AS anomaly_count,
      {pct("SUM(is_anomaly)", "COUNT(*)")} AS anomaly_pct
    FROM anomalies GROUP BY store_id ORDER BY anomaly_pct DESC, store_id LIMIT 50""",
)
def _(w):
    return anomalies.rank_by_rate(w.anomalies, "store_id")


WEEKS = f"""SELECT CAST(date_trunc('week', ds) AS DATE) AS forecast_date, store_id, sku,
  {isum("demand")} AS actual_qty FROM sales_daily GROUP BY 1, 2, 3"""


@query(
    "forecast_vs_actual",
    "G26",
    f"""SELECT forecast_date, store_id, sku, forecast_qty, actual_qty,
      {pct("ABS(actual_qty - forecast_qty)", "actual_qty")} AS mape
    FROM (SELECT *, LAG(actual_qty) OVER (PARTITION BY store_id, sku ORDER BY forecast_date)
      AS forecast_qty FROM ({WEEKS})) WHERE forecast_qty IS NOT NULL""",
)
def _(w):
    from pyspark.sql import Window

    # The stored forecast stands in as last week's demand of the same series.
    weeks = reports.weekly_demand(w.daily)
    series = Window.partitionBy("store_id", "sku").orderBy("forecast_date")
    forecasts = weeks.select(
        "forecast_date", "store_id", "sku", F.lag("actual_qty").over(series).alias("forecast_qty")
    ).where(F.col("forecast_qty").isNotNull())
    return reports.forecast_vs_actual(forecasts, w.daily)


@query(
    "replenishment",
    "G27 J10",
    f"""SELECT month, d.sku, supplier_id, demand, GREATEST(min_order_qty,
        CAST(CEIL(ROUND(demand * 1.1 / CAST(min_order_qty AS DOUBLE), 9)) AS BIGINT) * min_order_qty)
        AS order_qty
    FROM (SELECT CAST(date_trunc('month', date) AS DATE) AS month, sku, {isum("demand")} AS demand
      FROM sales_line GROUP BY 1, 2) d
    JOIN (SELECT sku, supplier_id FROM supplier_map WHERE is_primary) m ON d.sku = m.sku
    JOIN (SELECT supplier_id AS sid, min_order_qty FROM suppliers) t ON m.supplier_id = t.sid""",
)
def _(w):
    return reports.replenishment(w.line, w.supplier_product_map(), w.suppliers())


@query(
    "best_products",
    "G29",
    """SELECT sku, product_name, abc_class, lifetime_revenue, service_level FROM performance_gold
    ORDER BY lifetime_revenue DESC, sku LIMIT 10""",
)
def _(w):
    table = gold.product_performance(w.stg_products, w.monthly, w.stg_inventory)
    return reports.best_products(table)


@query(
    "sales_kpis",
    "G30",
    f"""SELECT {msum("revenue")} AS total_revenue, {isum("units_sold")} AS total_units,
      {r("AVG(CAST(revenue AS DOUBLE) / NULLIF(units_sold, 0))", 4)}
        AS avg_price, COUNT(DISTINCT sku) AS unique_skus FROM sales_line""",
)
def _(w):
    return reports.sales_kpis(w.line)


@query(
    "distinct_counts",
    "G6",
    """SELECT store_id, COUNT(DISTINCT sku) AS skus, COUNT(DISTINCT date) AS days
    FROM sales_line GROUP BY store_id""",
)
def _(w):
    return w.line.groupBy("store_id").agg(
        F.count_distinct("sku").alias("skus"), F.count_distinct("date").alias("days")
    )


SKETCHED = {
    "first_half": ("1992-01-01", "1995-06-30"),
    "second_half": ("1995-07-01", "1999-12-31"),
    "all": ("1990-01-01", "2030-12-31"),
}
_PERIODS = " UNION ALL ".join(
    f"SELECT '{name}' AS period, DATE '{first}' AS first, DATE '{last}' AS last"
    for name, (first, last) in SKETCHED.items()
)


def _daily_states(w):
    return stage(sketches.daily_states(w.line, "date", ["sku", "store_id"], ["revenue"]), "states")


@query(
    "sketched_distincts",
    "G6",
    f"""SELECT period, COUNT(*) AS rows, COUNT(DISTINCT sku) AS skus, COUNT(DISTINCT store_id) AS stores,
      TRUE AS skus_within, TRUE AS stores_within
    FROM sales_line JOIN ({_PERIODS}) ON date BETWEEN first AND last GROUP BY period""",
)
def _(w):
    # Periods from the stored states of days, beside exact counts from the rows.
    merged = sketches.merged(_daily_states(w), SKETCHED)
    named = F.explode(F.array(*(
        F.struct(F.lit(n).alias("period"), F.lit(a).cast("date").alias("first"), F.lit(b).cast("date").alias("last"))
        for n, (a, b) in SKETCHED.items()
    )))
    exact = (
        w.line.select("date", "sku", "store_id", named.alias("p"))
        .where(F.col("date").between(F.col("p.first"), F.col("p.last")))
        .groupBy("p.period")
        .agg(F.count_distinct("sku").alias("skus"), F.count_distinct("store_id").alias("stores"))
    )

    def within(column: str, count: str):
        return F.abs(sketches.distinct_count(column) - F.col(count)) <= F.col(count) * sketches.COUNT_ERROR + 1

    return merged.join(exact, "period").select(
        "period", "rows", "skus", "stores",
        within("sku", "skus").alias("skus_within"), within("store_id", "stores").alias("stores_within"),
    )


SHARES = (0.25, 0.5, 0.75, 0.9, 0.99)


@query(
    "sketched_quantiles",
    "G8",
    f"""SELECT period, CAST(share AS DOUBLE) AS share, rows, TRUE AS within
    FROM (SELECT period, COUNT(revenue) AS rows FROM sales_line JOIN ({_PERIODS})
        ON date BETWEEN first AND last GROUP BY period),
      (SELECT UNNEST([{", ".join(map(str, SHARES))}]) AS share)""",
)
def _(w):
    # Where the values found in the merged states of a period really stand among its rows.
    merged = sketches.merged(_daily_states(w), SKETCHED)
    found = merged.select("period", sketches.quantiles("revenue", SHARES).alias("found"))
    asked = found.select("period", F.posexplode("found").alias("place", "value"))
    bounds = F.create_map(*(F.lit(v) for i, s in enumerate(SHARES) for v in (i, s)))
    spans = F.create_map(*(F.lit(x) for n, (a, b) in SKETCHED.items() for x in (n, f"{a} {b}")))
    span = F.split(spans[F.col("period")], " ")
    table = stage(asked.withColumns({"first": span[0].cast("date"), "last": span[1].cast("date")}), "asked")
    ranks = (
        w.line.join(F.broadcast(table), F.col("date").between(F.col("first"), F.col("last")))  # a row per share asked
        .groupBy("period", "place")
        .agg(
            F.count("revenue").alias("rows"),
            F.count_if(F.col("revenue") < F.col("value")).alias("below"),
            F.count_if(F.col("revenue") <= F.col("value")).alias("through"),
        )
    )
    share = bounds[F.col("place")]
    low, high = F.col("below") / F.col("rows"), F.col("through") / F.col("rows")
    inside = (low <= share + sketches.RANK_ERROR) & (high >= share - sketches.RANK_ERROR)
    return ranks.select("period", share.alias("share"), "rows", inside.alias("within"))


# -- joins -------------------------------------------------------------------


@query(
    "orphan_orders",
    "J4",
    """SELECT o_orderkey AS key, COUNT(*) AS rows FROM orders
    WHERE o_orderkey IS NOT NULL AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    GROUP BY o_orderkey""",
)
def _(w):
    return quality.orphan_keys(w.table("orders"), "o_orderkey", w.table("lineitem"), "l_orderkey")


@query(
    "filtered_orphans",
    "J4 Q5",
    """SELECT o_orderkey AS key, COUNT(*) AS rows, TRUE AS adds_up, TRUE AS by_filter FROM orders
    WHERE o_orderkey IS NOT NULL AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem
      WHERE l_linenumber >= 4) GROUP BY o_orderkey""",
)
def _(w):
    # Orders without a fourth line, by a Bloom filter over the keys of those that have one.
    lines = w.table("lineitem").where("l_linenumber >= 4")
    found, facts = membership.anti_join(w.table("orders"), "o_orderkey", lines, "l_orderkey")
    whole = (F.col("ruled_out") + F.col("compared") == F.col("keys")) & (F.col("ruled_out") <= F.col("orphans"))
    return found.crossJoin(F.broadcast(facts.select(whole.alias("adds_up"), "by_filter")))  # one row


@query(
    "history_near_anomalies",
    "J7 P12 F8",
    """SELECT d.sku, d.store_id, d.event_ds, d.ds, f.units_sold, f.demand FROM event_days d
    JOIN features f ON d.sku = f.sku AND d.store_id = f.store_id AND d.ds = f.ds""",
)
def _(w):
    events = w.anomalies.where("is_anomaly = 1").select("sku", "store_id", "ds")
    history = w.anomaly_inputs.select("sku", "store_id", "ds", "units_sold", "demand")
    return anomalies.nearby_history(events, history)


@query(
    "forecastable_sales",
    "J8",
    f"""SELECT sku, COUNT(*) AS days, {isum("units_sold")} AS units FROM features
    WHERE sku IN (SELECT sku FROM sku_profile WHERE forecastable) GROUP BY sku""",
)
def _(w):
    from larder.operators import segments

    rows = segments.forecastable_rows(
        w.sold, segments.segment(w.sold, "sku")
    )
    return rows.groupBy("sku").agg(
        F.count(F.lit(1)).alias("days"), F.sum("units_sold").alias("units")
    )


@query(
    "primary_supplier_terms",
    "J10",
    """SELECT m.supplier_id, sku, min_order_qty, lead_time_days, payment_terms_days
    FROM supplier_map m JOIN suppliers s ON m.supplier_id = s.supplier_id WHERE is_primary""",
)
def _(w):
    return reports.primary_supplier_terms(w.supplier_product_map(), w.suppliers())


@query(
    "supplier_codes",
    "F14",
    """SELECT sku, supplier_id, supplier_id || '_' || sku AS supplier_sku, is_primary
    FROM supplier_map""",
)
def _(w):
    return w.supplier_product_map().select("sku", "supplier_id", "supplier_sku", "is_primary")


@query(
    "dense_calendar",
    "J12",
    f"""SELECT sku, COUNT(*) AS days, COUNT(*) FILTER (WHERE NOT observed) AS filled_days,
      {isum("units_sold")} AS units FROM (
      SELECT g.sku, d.ds IS NOT NULL AS observed, COALESCE(d.units_sold, 0) AS units_sold
      FROM (SELECT sku, store_id, UNNEST(generate_series(MIN(ds), MAX(ds), INTERVAL 1 DAY)) AS day
        FROM sales_daily GROUP BY sku, store_id) g
      LEFT JOIN sales_daily d
        ON g.sku = d.sku AND g.store_id = d.store_id AND CAST(g.day AS DATE) = d.ds)
    GROUP BY sku""",
)
def _(w):
    dense = features.fill_gaps(w.daily)
    return dense.groupBy("sku").agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if("is_filled").alias("filled_days"),
        F.sum("units_sold").alias("units"),
    )


@query(
    "shipment_flows",
    "J9",
    f"""SELECT s_nationkey AS origin, c_nationkey AS destination, COUNT(*) AS shipments,
      CAST(SUM(l_quantity) AS BIGINT) AS qty
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
      JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def _(w):
    return (
        w.shipments()
        .groupBy("origin", "destination")
        .agg(F.count(F.lit(1)).alias("shipments"), F.sum("qty").alias("qty"))
    )


# -- sorts, limits, unions ---------------------------------------------------


@query(
    "recent_rows",
    "T5",
    """SELECT ds, sku, store_id, units_sold, revenue FROM sales_daily
    ORDER BY ds DESC, sku, store_id LIMIT 500""",
)
def _(w):
    rows = reports.recent_rows(w.daily, 500, ["sku", "store_id"])
    return rows.select("ds", "sku", "store_id", "units_sold", "revenue")


@query("sku_domain", "T6", "SELECT DISTINCT sku FROM sales_daily ORDER BY sku")
def _(w):
    return reports.domain(w.daily, "sku")


@query(
    "peak_day",
    "T4",
    f"""SELECT ds, revenue, units_sold FROM (
      SELECT ds, {msum("revenue")} AS revenue, {isum("units_sold")} AS units_sold
      FROM sales_daily GROUP BY ds) ORDER BY revenue DESC, ds DESC LIMIT 1""",
)
def _(w):
    totals = w.daily.groupBy("ds").agg(
        exact_sum("revenue").alias("revenue"), F.sum("units_sold").alias("units_sold")
    )
    return reports.extreme_row(totals, "revenue", "ds")


@query(
    "all_sites",
    "T8",
    """SELECT 'supplier' AS kind, s_nationkey AS nation, COUNT(*) AS sites FROM supplier GROUP BY 2
    UNION ALL SELECT 'customer', c_nationkey, COUNT(*) FROM customer GROUP BY 2
    UNION ALL SELECT 'location', n_nationkey, COUNT(*) FROM nation GROUP BY 2""",
)
def _(w):
    def sites(df, kind, key):
        return df.select(F.lit(kind).alias("kind"), F.col(key).alias("nation"))

    rows = (
        sites(w.table("supplier"), "supplier", "s_nationkey")
        .unionByName(sites(w.table("customer"), "customer", "c_nationkey"))
        .unionByName(sites(w.table("nation"), "location", "n_nationkey"))
    )
    return rows.groupBy("kind", "nation").agg(F.count(F.lit(1)).alias("sites"))


# -- scalar functions over whole tables --------------------------------------


@query(
    "calendar_functions",
    "F5 F11",
    f"""SELECT quarter(date) AS quarter, (month(date) - 1) // 3 + 1 AS quarter_from_month,
      strftime(date, '%Y-%m') AS year_month, COUNT(*) AS lines,
      {isum("CAST(stockout_flag AS INTEGER)")} AS stockouts
    FROM sales_line GROUP BY 1, 2, 3""",
)
def _(w):
    day = F.col("date")
    return w.line.groupBy(
        F.quarter(day).alias("quarter"),
        F.expr("(month(date) - 1) div 3 + 1").alias("quarter_from_month"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
    ).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("stockout_flag").cast("int")).alias("stockouts")
    )


@query(
    "math_functions",
    "F9",
    f"""SELECT category, {r("AVG(ABS(unit_price - unit_cost))", 4)} AS mean_gap,
      {r("AVG(SQRT(unit_price))", 4)} AS mean_root, {r("AVG(LN(unit_price))", 4)} AS mean_log,
      CAST(SUM(CEIL(unit_cost)) AS BIGINT) AS ceil_cost,
      {r("AVG(GREATEST(unit_cost, 600))", 2)} AS floored_cost FROM products GROUP BY category""",
)
def _(w):
    price, cost = F.col("unit_price"), F.col("unit_cost")
    return w.products().groupBy("category").agg(
        round_to(F.avg(F.abs(price - cost)), 4).alias("mean_gap"),
        round_to(F.avg(F.sqrt(price)), 4).alias("mean_root"),
        round_to(F.avg(F.log(price)), 4).alias("mean_log"),
        F.sum(F.ceil(cost)).alias("ceil_cost"),
        round_to(F.avg(F.greatest(cost, F.lit(600.0))), 2).alias("floored_cost"),
    )
