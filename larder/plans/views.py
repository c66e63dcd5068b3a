"""SQL definitions of the shared tables, for the checking engine."""

from __future__ import annotations

from larder.plans.registry import isum, msum, pct, r, view

view(
    "sales_line",
    """SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS store_id, l_partkey AS sku,
      CAST(l_quantity AS BIGINT) AS units_sold,
      CAST(l_quantity AS BIGINT) + CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END AS demand,
      CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
        AS DECIMAL(18,4)) AS revenue,
      l_discount >= CAST(0.09 AS DOUBLE) AS is_promo, l_returnflag = 'R' AS stockout_flag
    FROM lineitem""",
)
view(
    "sales_daily",
    f"""SELECT p_brand AS sku, s_nationkey AS store_id, date AS ds,
      {isum("units_sold")} AS units_sold, {isum("demand")} AS demand,
      CAST(SUM(revenue) AS DOUBLE) AS revenue, BOOL_OR(is_promo) AS is_promo,
      SUM(demand) > SUM(units_sold) AS stockout_flag
    FROM sales_line JOIN part ON sku = p_partkey JOIN supplier ON store_id = s_suppkey
    GROUP BY p_brand, s_nationkey, date""",
)
view(
    "products",
    """SELECT p_partkey AS sku, p_name AS product_name, p_type AS category,
      p_retailprice * (50 + p_size % 40) / CAST(100 AS DOUBLE) AS unit_cost,
      p_size * CAST(0.1 AS DOUBLE) AS unit_weight_kg,
      CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size * 7 END AS shelf_life_days,
      p_size > 45 AS is_hazardous,
      CASE WHEN p_size <= 10 THEN 'A' WHEN p_size <= 25 THEN 'B' ELSE 'C' END AS abc_class,
      p_retailprice AS unit_price, 3 + p_size % 12 AS safety_stock_days
    FROM part""",
)
view(
    "suppliers",
    """SELECT s_suppkey AS supplier_id, s_name AS supplier_name, r_name AS region,
      5 + s_suppkey % 25 AS lead_time_days, 1 + s_suppkey % 5 AS lead_time_std,
      CASE WHEN s_suppkey % 17 = 0 THEN NULL
        ELSE (60 + s_suppkey % 40) / CAST(100 AS DOUBLE) END AS reliability_score,
      1 + (s_suppkey % 10) / CAST(10 AS DOUBLE) AS unit_cost_multiplier,
      10 * (1 + s_suppkey % 10) AS min_order_qty,
      CASE WHEN s_acctbal < 0 THEN 15 ELSE 30 END AS payment_terms_days
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey""",
)
view(
    "locations",
    """SELECT n_nationkey AS location_id,
      CASE n_nationkey % 5 WHEN 0 THEN 'PLANT' WHEN 1 THEN 'DC' ELSE 'STORE' END AS location_type,
      n_name AS location_name, r_name AS region,
      1000 + 100 * n_nationkey AS capacity_units_per_day
    FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
view(
    "purchase_orders",
    """SELECT l_orderkey || '-' || l_linenumber AS po_id, l_suppkey AS supplier_id,
      l_partkey AS sku,
      CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS order_qty,
      l_extendedprice / l_quantity AS unit_cost, CAST(o_orderdate AS DATE) AS order_date,
      CAST(o_orderdate AS DATE) + 30 AS expected_date,
      CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS actual_date,
      CAST(l_shipdate AS DATE) AS ship_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
view(
    "inventory",
    """SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS snapshot_date,
      l_suppkey AS location_id, l_partkey AS sku,
      CASE WHEN l_linenumber = 7 THEN NULL ELSE (CAST(l_quantity AS BIGINT) - 1) * 2 END AS on_hand_qty,
      CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber * 5 END AS in_transit_qty,
      CASE WHEN l_tax >= CAST(0.07 AS DOUBLE) THEN NULL ELSE l_linenumber - 1 END AS backorder_qty,
      CAST(l_extendedprice AS DECIMAL(18,4)) AS inventory_value
    FROM lineitem""",
)
view(
    "shipments",
    """SELECT s_nationkey AS origin, c_nationkey AS destination, l_partkey AS sku
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
      JOIN customer ON o_custkey = c_custkey""",
)
view(
    "supplier_map",
    """SELECT sku, supplier_id, supplier_id = MIN(supplier_id) OVER (PARTITION BY sku) AS is_primary
    FROM (SELECT DISTINCT l_partkey AS sku, l_suppkey AS supplier_id FROM lineitem)""",
)
view(
    "stg_products",
    f"""SELECT *, unit_price - unit_cost AS unit_margin,
      {pct("unit_price - unit_cost", "unit_price")} AS margin_pct FROM products""",
)
view(
    "stg_sales",
    """SELECT date, store_id, sku, units_sold, demand, demand - units_sold AS lost_sales,
      revenue, is_promo, stockout_flag,
      CAST(date_trunc('week', date) AS DATE) AS week_start,
      CAST(date_trunc('month', date) AS DATE) AS month_start,
      CAST(date_trunc('quarter', date) AS DATE) AS quarter_start,
      year(date) AS year, month(date) AS month, dayofweek(date) + 1 AS day_of_week,
      dayofyear(date) AS day_of_year,
      CASE WHEN month(date) >= 4 THEN year(date) ELSE year(date) - 1 END AS fiscal_year,
      CASE WHEN month(date) >= 4 THEN month(date) - 3 ELSE month(date) + 9 END AS fiscal_month
    FROM sales_line WHERE units_sold IS NOT NULL""",
)
view(
    "stg_inventory",
    """SELECT *, COALESCE(on_hand_qty, 0) + COALESCE(in_transit_qty, 0) AS total_available_qty,
      COALESCE(on_hand_qty, 0) + COALESCE(in_transit_qty, 0) - COALESCE(backorder_qty, 0)
        AS net_position,
      on_hand_qty = 0 AS is_stockout, on_hand_qty < 50 AS is_low_stock,
      CAST(date_trunc('month', snapshot_date) AS DATE) AS month_start,
      year(snapshot_date) AS year, month(snapshot_date) AS month
    FROM inventory WHERE on_hand_qty IS NOT NULL""",
)

VOLUME = f"""{isum("units_sold")} AS total_units, {isum("demand")} AS total_demand,
  {isum("lost_sales")} AS total_lost_sales, {r(msum("revenue"), 2)} AS total_revenue,
  {isum("CASE WHEN is_promo THEN units_sold ELSE 0 END")} AS promo_units,
  {r(msum("CASE WHEN is_promo THEN revenue ELSE 0 END"), 2)} AS promo_revenue,
  {isum("CASE WHEN stockout_flag THEN 1 ELSE 0 END")} AS stockout_days,
  {pct("SUM(units_sold)", "SUM(demand)")} AS fill_rate"""

view(
    "monthly_gold",
    f"""SELECT month_start, year, month, store_id, sku, {VOLUME}, COUNT(*) AS total_days,
      {pct("SUM(CASE WHEN stockout_flag THEN 1 ELSE 0 END)", "COUNT(*)")} AS stockout_rate
    FROM stg_sales GROUP BY month_start, year, month, store_id, sku""",
)
view(
    "performance_gold",
    f"""SELECT p.sku, product_name, category, abc_class, unit_cost, unit_price, margin_pct,
      COALESCE(lifetime_units, 0) AS lifetime_units,
      COALESCE(lifetime_revenue, 0) AS lifetime_revenue, COALESCE(num_stores, 0) AS num_stores,
      first_sale_date, last_sale_date,
      {r("COALESCE(avg_fill_rate, 0)", 4)} AS avg_fill_rate,
      {r("COALESCE(avg_on_hand, 0)", 4)} AS avg_on_hand,
      {r("COALESCE(avg_inventory_value, 0)", 4)} AS avg_inventory_value,
      {pct("COALESCE(stockout_days, 0)", "total_days")} AS stockout_rate,
      {r("100 - CAST(COALESCE(stockout_days, 0) AS DOUBLE) / NULLIF(CAST(total_days AS DOUBLE), 0) * 100", 2)}
        AS service_level,
      {pct("stockout_snapshots", "total_snapshots")} AS inventory_stockout_rate
    FROM stg_products p
    LEFT JOIN (SELECT sku, {isum("total_units")} AS lifetime_units,
        {msum("total_revenue")} AS lifetime_revenue, {isum("stockout_days")} AS stockout_days,
        {isum("total_days")} AS total_days, COUNT(DISTINCT store_id) AS num_stores,
        MIN(month_start) AS first_sale_date, MAX(month_start) AS last_sale_date,
        {msum("fill_rate")} / COUNT(fill_rate) AS avg_fill_rate
      FROM monthly_gold GROUP BY sku) s ON p.sku = s.sku
    LEFT JOIN (SELECT sku, AVG(on_hand_qty) AS avg_on_hand,
        {msum("inventory_value")} / COUNT(inventory_value) AS avg_inventory_value,
        COUNT(*) FILTER (WHERE is_stockout) AS stockout_snapshots, COUNT(*) AS total_snapshots
      FROM stg_inventory GROUP BY sku) i ON p.sku = i.sku""",
)


def rolling(n: int) -> str:
    frame = f"(PARTITION BY sku, store_id ORDER BY ds ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"""AVG(units_sold) OVER {frame} AS units_sold_roll_mean_{n},
      STDDEV_SAMP(units_sold) OVER {frame} AS units_sold_roll_std_{n},
      MIN(units_sold) OVER {frame} AS units_sold_roll_min_{n},
      MAX(units_sold) OVER {frame} AS units_sold_roll_max_{n}"""


LAGS = ", ".join(
    f"LAG(units_sold, {n}) OVER (PARTITION BY sku, store_id ORDER BY ds) AS units_sold_lag_{n}"
    for n in (7, 14, 30)
)
CALENDAR = """dayofweek(ds) + 1 AS day_of_week, dayofyear(ds) AS day_of_year,
  month(ds) AS month, year(ds) AS year, quarter(ds) AS quarter,
  CASE WHEN dayofweek(ds) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN day(ds) <= 7 THEN 1 ELSE 0 END AS is_month_start,
  CASE WHEN day(ds) >= 24 THEN 1 ELSE 0 END AS is_month_end"""
TOTALS = """CAST(SUM(units_sold) OVER (PARTITION BY sku, ds) AS BIGINT) AS sku_total_qty,
  CAST(SUM(units_sold) OVER (PARTITION BY store_id, ds) AS BIGINT) AS store_total_qty"""

view(
    "features",
    f"""SELECT *, {CALENDAR} FROM (
      SELECT *, {TOTALS}, {LAGS}, {rolling(7)}, {rolling(14)}, {rolling(30)} FROM sales_daily)
    WHERE units_sold_lag_7 IS NOT NULL""",
)
view(
    "stats",
    """SELECT AVG(units_sold) AS um, STDDEV_SAMP(units_sold) AS us,
      QUANTILE_CONT(units_sold, 0.25) AS uq1, QUANTILE_CONT(units_sold, 0.75) AS uq3,
      AVG(revenue) AS rm, STDDEV_SAMP(revenue) AS rs,
      QUANTILE_CONT(revenue, 0.25) AS rq1, QUANTILE_CONT(revenue, 0.75) AS rq3
    FROM features""",
)

DEVIATION = """(units_sold - units_sold_roll_mean_7)
  / CASE WHEN units_sold_roll_std_7 = 0 THEN 1 ELSE units_sold_roll_std_7 END"""
LOST = """CAST(demand AS DOUBLE)
  / CASE WHEN units_sold = 0 THEN 1 ELSE CAST(units_sold AS DOUBLE) END - 1"""


def zscore(c: str, mean: str, std: str) -> str:
    return f"CASE WHEN ABS({c} - {mean}) / NULLIF({std}, 0) > 3 THEN 1 ELSE 0 END"


def iqr(c: str, q1: str, q3: str) -> str:
    return f"""CASE WHEN {c} < {q1} - ({q3} - {q1}) * 1.5 OR {c} > {q3} + ({q3} - {q1}) * 1.5
      THEN 1 ELSE 0 END"""


SCORE = """anomaly_demand_zscore + anomaly_demand_iqr + anomaly_demand_contextual + anomaly_stockout
  + anomaly_high_lost_sales + anomaly_revenue_zscore + anomaly_revenue_iqr
  + anomaly_isolation_forest"""
view(
    "anomalies",
    f"""SELECT *, CASE WHEN anomaly_score >= 2 THEN 1 ELSE 0 END AS is_anomaly
    FROM (SELECT *, {SCORE} AS anomaly_score FROM (
      SELECT features.*, {DEVIATION} AS demand_deviation, {LOST} AS lost_sales_ratio,
        {zscore("units_sold", "um", "us")} AS anomaly_demand_zscore,
        {iqr("units_sold", "uq1", "uq3")} AS anomaly_demand_iqr,
        CASE WHEN ABS({DEVIATION}) > 2.5 THEN 1 ELSE 0 END AS anomaly_demand_contextual,
        CAST(stockout_flag AS INTEGER) AS anomaly_stockout,
        CASE WHEN {LOST} > 0.2 THEN 1 ELSE 0 END AS anomaly_high_lost_sales,
        {zscore("revenue", "rm", "rs")} AS anomaly_revenue_zscore,
        {iqr("revenue", "rq1", "rq3")} AS anomaly_revenue_iqr,
        0 AS anomaly_isolation_forest
      FROM features CROSS JOIN stats))""",
)


def segment(key: str, volume: int, source: str = "features") -> str:
    return f"""SELECT *, COALESCE(total_volume >= {volume} AND cv <= 1.5 AND nonzero_pct >= 0.3, FALSE)
      AS forecastable FROM (
      SELECT {key}, {isum("units_sold")} AS total_volume, AVG(units_sold) AS mean_demand,
        STDDEV_SAMP(units_sold) AS std_demand, COUNT(units_sold) AS n_days,
        COUNT(*) FILTER (WHERE units_sold > 0) AS nonzero_days,
        STDDEV_SAMP(units_sold) / NULLIF(AVG(units_sold), 0) AS cv,
        COUNT(*) FILTER (WHERE units_sold > 0) / CAST(COUNT(units_sold) AS DOUBLE) AS nonzero_pct
      FROM {source} GROUP BY {key})"""


def pareto(source: str) -> str:
    return f"""SELECT *, CASE WHEN cumulative_pct <= 0.7 THEN 'A' WHEN cumulative_pct <= 0.9 THEN 'B'
      ELSE 'C' END AS abc_class
    FROM (SELECT *, CAST(SUM(total_volume) OVER (ORDER BY total_volume DESC, sku
          ROWS UNBOUNDED PRECEDING) AS DOUBLE)
        / CAST(SUM(total_volume) OVER () AS DOUBLE) AS cumulative_pct FROM {source})"""


view("sku_profile", segment("sku", 100))
view("sku_segments", pareto("sku_profile"))
view("part_profile", segment("sku", 100, "sales_line"))
view("part_segments", pareto("part_profile"))
view("store_segments", segment("store_id", 500))
view(
    "split_features",
    """SELECT *, date_diff('day', DATE '1970-01-01', ds) >=
        (SELECT QUANTILE_CONT(date_diff('day', DATE '1970-01-01', ds), 0.8) FROM features) AS is_test
    FROM features""",
)
view(
    "predictions",
    " UNION ALL ".join(
        f"""SELECT '{model}' AS model, ds, sku, store_id, CAST(units_sold AS DOUBLE) AS actual,
          CAST({column} AS DOUBLE) AS pred FROM split_features WHERE is_test"""
        for model, column in (
            ("lag_7", "units_sold_lag_7"),
            ("mean_7", "units_sold_roll_mean_7"),
            ("mean_30", "units_sold_roll_mean_30"),
        )
    ),
)


def accuracy(source: str, by: str, order: str) -> str:
    """All metrics of a frame with actual and pred, grouped by a comma list."""
    partition = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    error = "ABS(actual - pred)"
    size = "(ABS(actual) + ABS(pred))"
    total = "(CASE WHEN SUM(actual) > 0 THEN SUM(actual) END)"

    def hit(limit: str) -> str:
        return f"""100 * CAST(COUNT(*) FILTER (WHERE actual > 0 AND {error} / NULLIF(actual, 0) <= {limit})
          AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE actual > 0), 0)"""

    return f"""SELECT {keys}COUNT(*) AS n_records, SUM(actual) AS total_actual,
      {r(f"AVG({error})", 2)} AS mae, {r(f"SQRT(AVG({error} * {error}))", 2)} AS rmse,
      {r(f"SUM({error}) / {total} * 100", 2)} AS wape,
      {r(f"(SUM(pred) - SUM(actual)) / {total} * 100", 2)} AS bias,
      {r(f"AVG({error}) / NULLIF(SUM(step) / NULLIF(COUNT(*) - 1, 0), 0)", 3)} AS mase,
      {r(hit("0.2"), 1)} AS hit_rate_20, {r(hit("0.1"), 1)} AS hit_rate_10,
      {r(f"AVG(CASE WHEN {size} > 0 THEN 2 * {error} / {size} END) * 100", 2)} AS smape,
      {r(f"AVG(ABS({error} / NULLIF(actual, 0))) * 100", 2)} AS mape
    FROM (SELECT *, ABS(actual - LAG(actual) OVER ({partition} ORDER BY {order})) AS step
      FROM {source}) {f"GROUP BY {by}" if by else ""}"""


view(
    "daily_predictions",
    """SELECT model, ds, SUM(actual) AS actual, SUM(pred) AS pred
    FROM predictions GROUP BY model, ds""",
)
view(
    "comparison",
    f"""SELECT model, CASE model WHEN 'mean_30' THEN 'TimeSeries' ELSE 'ML' END AS type,
      mae, rmse, wape, bias, mase, hit_rate_20, hit_rate_10, smape
    FROM ({accuracy("daily_predictions", "model", "ds")})""",
)
view(
    "metrics_by_sku",
    f"""SELECT m.*, forecastable, abc_class, {r("cv", 2)} AS cv
    FROM ({accuracy("predictions", "model, sku", "ds, store_id")}) m LEFT JOIN sku_segments s ON m.sku = s.sku
    WHERE n_records >= 5""",
)
view(
    "event_days",
    """SELECT sku, store_id, event_ds, event_ds + shift AS ds
    FROM (SELECT sku, store_id, ds AS event_ds, CAST(UNNEST(range(-7, 2)) AS INTEGER) AS shift
      FROM anomalies WHERE is_anomaly = 1)""",
)
