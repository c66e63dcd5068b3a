"""Feature and anomaly queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import round_to
from larder.operators import anomalies, features, isolation, ranks, reports
from larder.plans.registry import isum, msum, pct, query, r
from larder.plans.views import CALENDAR, LAGS, LOST, TOTALS, rolling
from larder.session import stage

STD = "units_sold_roll_std_"


def _rounded(df):
    """Rolling deviations may differ in the last digits between engines."""
    wide = [c for c, t in df.dtypes if t == "double" and ("_std_" in c or "_mean_" in c)]
    return df.withColumns({c: round_to(c, 4) for c in wide})


def _rounded_sql(*spans: int) -> str:
    return ", ".join(
        f"{r(f'units_sold_roll_{m}_{n}', 4)} AS units_sold_roll_{m}_{n}"
        for n in spans
        for m in ("mean", "std")
    )


@query("lag_features", "W1", f"SELECT *, {LAGS} FROM sales_daily")
def _(w):
    return features.add_lag_features(w.daily)


@query(
    "rolling_features",
    "W2",
    f"""SELECT * REPLACE ({_rounded_sql(7, 14, 30)})
    FROM (SELECT *, {rolling(7)}, {rolling(14)}, {rolling(30)} FROM sales_daily)""",
)
def _(w):
    return _rounded(features.add_rolling_features(w.daily))


@query("calendar_features", "W3", f"SELECT *, {CALENDAR} FROM sales_daily")
def _(w):
    return features.add_calendar_features(w.daily)


@query("cross_totals", "W4 J2", f"SELECT *, {TOTALS} FROM sales_daily")
def _(w):
    return features.add_cross_totals(w.daily)


@query(
    "demand_features", "W5 P6", f"SELECT * REPLACE ({_rounded_sql(7, 14, 30)}) FROM features"
)
def _(w):
    return _rounded(w.features)


# Days from here on are added to a state of the days before, in two steps.
ADDED = ("1998-01-01", "1998-06-01")


@query(
    "incremental_features",
    "W5 W1 W2 W4",
    f"""SELECT * REPLACE ({_rounded_sql(7, 14, 30)}) FROM features WHERE ds >= DATE '{ADDED[0]}'""",
)
def _(w):
    # The features of new days from the last rows of each series, as the full build has them.
    daily = stage(w.daily, "daily")
    first, second = (F.lit(d).cast("date") for d in ADDED)
    state = stage(features.feature_state(daily.where(F.col("ds") < first)), "state")
    built, state = features.new_features(state, daily.where((F.col("ds") >= first) & (F.col("ds") < second)))
    later, _ = features.new_features(stage(state, "state"), daily.where(F.col("ds") >= second))
    return _rounded(built.unionByName(later))


@query(
    "week_over_week",
    "W9",
    f"""SELECT COUNT(*) AS days, CAST(SUM(revenue) FILTER (WHERE age <= 7) AS DOUBLE) AS recent,
      CAST(SUM(revenue) FILTER (WHERE age BETWEEN 8 AND 14) AS DOUBLE) AS prior,
      CASE WHEN COUNT(*) >= 14 AND SUM(revenue) FILTER (WHERE age BETWEEN 8 AND 14) > 0 THEN
        {r('''(CAST(SUM(revenue) FILTER (WHERE age <= 7) AS DOUBLE)
          - CAST(SUM(revenue) FILTER (WHERE age BETWEEN 8 AND 14) AS DOUBLE))
          / CAST(SUM(revenue) FILTER (WHERE age BETWEEN 8 AND 14) AS DOUBLE) * 100''', 4)}
        ELSE 0 END AS trend_pct
    FROM (SELECT ds, SUM(CAST(revenue AS DECIMAL(18,4))) AS revenue,
        ROW_NUMBER() OVER (ORDER BY ds DESC) AS age FROM sales_daily GROUP BY ds)""",
)
def _(w):
    trend = features.week_over_week(reports.daily_totals(w.daily))
    return trend.withColumn("trend_pct", round_to("trend_pct", 4))


@query(
    "date_gaps",
    "W10",
    """SELECT * FROM (SELECT sku, store_id, ds,
      LAG(ds) OVER (PARTITION BY sku, store_id ORDER BY ds) AS previous_ds,
      date_diff('day', LAG(ds) OVER (PARTITION BY sku, store_id ORDER BY ds), ds) AS gap_days
    FROM sales_daily) WHERE gap_days > 1""",
)
def _(w):
    return features.date_gaps(w.daily)


@query(
    "group_zscore",
    "W11",
    f"""SELECT sku, store_id, ds, units_sold, {r('''COALESCE((units_sold - AVG(units_sold) OVER s)
      / NULLIF(STDDEV_SAMP(units_sold) OVER s, 0), 0)''', 4)} AS zscore
    FROM sales_daily WINDOW s AS (PARTITION BY sku)""",
)
def _(w):
    scored = features.group_zscore(w.daily, "units_sold")
    return scored.select("sku", "store_id", "ds", "units_sold", round_to("zscore", 4).alias("zscore"))


# -- anomalies ---------------------------------------------------------------


@query(
    "global_moments",
    "G7",
    f"""SELECT {r("AVG(units_sold)", 4)} AS units_sold_mean,
      {r("STDDEV_SAMP(units_sold)", 4)} AS units_sold_std, {r("AVG(demand)", 4)} AS demand_mean,
      {r("STDDEV_SAMP(demand)", 4)} AS demand_std FROM sales_line""",
)
def _(w):
    found = anomalies.moments(w.line, ["units_sold", "demand"])
    return found.select(*(round_to(c, 4).alias(c) for c in found.columns))


@query(
    "revenue_quantiles",
    "G8",
    f"""SELECT {r("QUANTILE_CONT(CAST(revenue AS DOUBLE), 0.25)", 4)} AS revenue_q1,
      {r("QUANTILE_CONT(CAST(revenue AS DOUBLE), 0.5)", 4)} AS revenue_median,
      {r("QUANTILE_CONT(CAST(revenue AS DOUBLE), 0.75)", 4)} AS revenue_q3,
      {r("QUANTILE_CONT(CAST(revenue AS DOUBLE), 0.95)", 4)} AS revenue_p95 FROM sales_line""",
)
def _(w):
    wanted = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p95": 0.95}
    found = ranks.exact_quantiles(w.line, ["revenue"], wanted)
    return found.select(*(round_to(c, 4).alias(c) for c in found.columns))


@query(
    "global_stats",
    "A7",
    f"""SELECT {r("um", 4)} AS units_sold_mean, {r("rm", 4)} AS revenue_mean,
      {r("us", 4)} AS units_sold_std, {r("rs", 4)} AS revenue_std,
      {r("uq1", 4)} AS units_sold_q1, {r("uq3", 4)} AS units_sold_q3,
      {r("rq1", 4)} AS revenue_q1, {r("rq3", 4)} AS revenue_q3 FROM stats""",
)
def _(w):
    found = anomalies.global_stats(w.stored(*anomalies.MEASURES))
    return found.select(*(round_to(c, 4).alias(c) for c in found.columns))


FLAG_KEYS = ", ".join(
    ("ds", "sku", "store_id", "units_sold", "demand", "anomaly_score", "is_anomaly")
    + anomalies.FLAGS
)


@query(
    "anomaly_flags",
    "A1 A2 A3 A4 A5 A6 A9 J5",
    f"""SELECT {FLAG_KEYS}, {r("demand_deviation", 4)} AS demand_deviation,
      {r("lost_sales_ratio", 4)} AS lost_sales_ratio FROM anomalies""",
)
def _(w):
    return w.anomalies.select(
        *FLAG_KEYS.split(", "),
        round_to("demand_deviation", 4).alias("demand_deviation"),
        round_to("lost_sales_ratio", 4).alias("lost_sales_ratio"),
    )


SUMMARY = " UNION ALL ".join(
    f"SELECT '{f}' AS anomaly_type, {isum(f)} AS count, {pct(f'SUM({f})', 'COUNT(*)')} AS pct FROM anomalies"
    for f in anomalies.FLAGS
)


@query(
    "anomaly_summary",
    "A10 T7",
    f"""{SUMMARY} UNION ALL SELECT 'total_flagged', {isum("is_anomaly")},
      {pct("SUM(is_anomaly)", "COUNT(*)")} FROM anomalies""",
)
def _(w):
    return anomalies.anomaly_summary(w.anomalies)


@query(
    "flag_counts",
    "A17",
    f"""{SUMMARY} UNION ALL SELECT 'is_anomaly', {isum("is_anomaly")},
      {pct("SUM(is_anomaly)", "COUNT(*)")} FROM anomalies""",
)
def _(w):
    return anomalies.flag_counts(w.anomalies)


@query(
    "top_anomalies",
    "A11",
    f"""SELECT ds, sku, store_id, units_sold, demand, revenue, anomaly_score, is_anomaly,
      {", ".join(anomalies.FLAGS)} FROM anomalies WHERE is_anomaly = 1
    ORDER BY anomaly_score DESC, ds DESC, sku, store_id LIMIT 100""",
)
def _(w):
    return anomalies.top_anomalies(w.anomalies)


def by_key(key: str) -> str:
    return f"""SELECT {key}, COUNT(*) AS total_records, {isum("is_anomaly")} AS anomaly_count,
      {pct("SUM(is_anomaly)", "COUNT(*)")} AS anomaly_pct
    FROM anomalies GROUP BY {key} ORDER BY anomaly_count DESC, {key} LIMIT 50"""


@query("anomalies_by_sku", "A12", by_key("sku"))
def _(w):
    return anomalies.anomalies_by(w.anomalies, "sku")


@query("anomalies_by_store", "A12", by_key("store_id"))
def _(w):
    return anomalies.anomalies_by(w.anomalies, "store_id")


@query(
    "anomalies_by_date",
    "A13",
    f"""SELECT ds AS date, COUNT(*) AS total_records, {isum("is_anomaly")} AS anomaly_count
    FROM anomalies GROUP BY ds""",
)
def _(w):
    return anomalies.anomalies_by_date(w.anomalies)


@query(
    "anomaly_rate",
    "A13",
    f"""SELECT COUNT(*) AS total_records, {isum("is_anomaly")} AS total_anomalies,
      {pct("SUM(is_anomaly)", "COUNT(*)")} AS anomaly_rate FROM anomalies""",
)
def _(w):
    return anomalies.anomaly_rate(w.anomalies)


_TYPES = ", ".join(
    f"CASE WHEN {name} = 1 THEN '{name.removeprefix('anomaly_')}' END" for name in anomalies.FLAGS
)


@query(
    "anomaly_context",
    "A14",
    f"""SELECT a.ds, a.sku, a.store_id, a.anomaly_score, a.units_sold, a.anomaly_types,
      {r("b.avg_units", 4)} AS avg_units, {r("b.std_units", 4)} AS std_units,
      {r("b.avg_revenue", 2)} AS avg_revenue, COUNT(f.ds) AS history_days,
      STRING_AGG(strftime(f.ds, '%Y-%m-%d') || ':' || f.units_sold || '/' || f.demand, ' ' ORDER BY f.ds)
        AS history, {msum("f.revenue")} AS history_revenue
    FROM (SELECT *, concat_ws(',', {_TYPES}) AS anomaly_types FROM anomalies) a
    JOIN features f ON a.sku = f.sku AND a.store_id = f.store_id
      AND f.ds BETWEEN a.ds - 7 AND a.ds + 1
    JOIN (SELECT sku, store_id, AVG(units_sold) AS avg_units, STDDEV_SAMP(units_sold) AS std_units,
        AVG(revenue) AS avg_revenue FROM features GROUP BY sku, store_id) b
      ON a.sku = b.sku AND a.store_id = b.store_id
    WHERE a.is_anomaly = 1
    GROUP BY a.ds, a.sku, a.store_id, a.anomaly_score, a.units_sold, a.anomaly_types, b.avg_units, b.std_units,
      b.avg_revenue""",
)
def _(w):
    day = F.transform(
        "history",
        lambda h: F.concat(
            h["ds"].cast("string"),
            F.lit(":"),
            h["units_sold"].cast("string"),
            F.lit("/"),
            h["demand"].cast("string"),
        ),
    )
    return anomalies.anomaly_context(w.anomalies).select(
        "ds",
        "sku",
        "store_id",
        "anomaly_score",
        "units_sold",
        F.array_join("anomaly_types", ",").alias("anomaly_types"),
        round_to("avg_units", 4).alias("avg_units"),
        round_to("std_units", 4).alias("std_units"),
        round_to("avg_revenue", 2).alias("avg_revenue"),
        F.size("history").cast("bigint").alias("history_days"),
        F.array_join(day, " ").alias("history"),
        F.aggregate(
            "history",
            F.lit(0).cast("decimal(28,4)"),
            lambda total, h: (total + h["revenue"].cast("decimal(18,4)")).cast("decimal(28,4)"),
        ).alias("history_revenue"),
    )


@query(
    "deviation_ranking",
    "A15",
    f"""SELECT sku, store_id, ds, {r("anomaly_score", 4)} AS anomaly_score FROM (
      SELECT sku, store_id, ds,
        ABS(units_sold - units_sold_roll_mean_7) / units_sold_roll_std_7 AS anomaly_score
      FROM features WHERE units_sold_roll_std_7 > 0)
    ORDER BY {r("anomaly_score", 4)} DESC, ds, sku, store_id LIMIT 25""",
)
def _(w):
    return anomalies.deviation_ranking(w.features, 25).withColumn(
        "anomaly_score", round_to("anomaly_score", 4)
    )


@query(
    "outlier_counts",
    "A16",
    f"""SELECT 'demand' AS "column",
      {isum("CASE WHEN ABS(demand - m) / NULLIF(s, 0) > 3 THEN 1 ELSE 0 END")} AS zscore_outliers,
      {isum("CASE WHEN demand < q1 - (q3 - q1) * 1.5 OR demand > q3 + (q3 - q1) * 1.5 THEN 1 ELSE 0 END")}
        AS iqr_outliers
    FROM sales_daily CROSS JOIN (SELECT AVG(demand) AS m, STDDEV_SAMP(demand) AS s,
      QUANTILE_CONT(demand, 0.25) AS q1, QUANTILE_CONT(demand, 0.75) AS q3 FROM sales_daily)""",
)
def _(w):
    from larder.session import stage

    daily = stage(w.daily.select("demand"), "daily")
    return anomalies.outlier_counts(daily, ["demand"], anomalies.global_stats(daily, ["demand"]))


@query("isolation_flags", "A8")
def _(w):
    from larder.session import stage

    table = w.anomaly_inputs
    scored = stage(isolation.fit_isolation_forest(table).score(table), "scored")
    return isolation.isolation_flags(scored).select(
        "ds", "sku", "store_id", round_to("isolation_score", 6).alias("isolation_score"),
        anomalies.ISOLATION,
    )


@query("anomaly_table", "J6 A9")
def _(w):
    return w.forest_table


SQL_FLAGS = ", ".join(f for f in anomalies.FLAGS if f != anomalies.ISOLATION)


@query(
    "anomaly_table_sql_flags",
    "A9",
    f"SELECT ds, sku, store_id, {SQL_FLAGS}, anomaly_score AS other_flags FROM anomalies",
)
def _(w):
    table = w.forest_table
    return table.select(
        "ds", "sku", "store_id", *SQL_FLAGS.split(", "),
        (F.col("anomaly_score") - F.col(anomalies.ISOLATION)).alias("other_flags"),
    )


@query(
    "forest_share",
    "A8",
    "SELECT COUNT(*) AS rows, TRUE AS some_flagged, TRUE AS at_most_5_pct FROM features",
)
def _(w):
    flagged = F.sum(anomalies.ISOLATION)
    rows = F.count(F.lit(1))
    return w.forest_table.agg(
        rows.alias("rows"),
        (flagged > 0).alias("some_flagged"),
        (flagged <= F.ceil(rows * 0.05)).alias("at_most_5_pct"),
    )


@query(
    "flag_update",
    "J6",
    f"""SELECT ds, sku, store_id, {SQL_FLAGS}, anomaly_isolation_forest, anomaly_score,
      CASE WHEN anomaly_score >= 2 THEN 1 ELSE 0 END AS is_anomaly
    FROM (SELECT * REPLACE (CASE WHEN units_sold > 60 THEN 1 ELSE 0 END AS anomaly_isolation_forest,
      anomaly_score + CASE WHEN units_sold > 60 THEN 1 ELSE 0 END AS anomaly_score) FROM anomalies)""",
)
def _(w):
    # The update join on a flag that SQL can compute too; keys repeat, some are missing.
    table = w.anomaly_inputs
    busy = table.where("units_sold > 60").select(
        "ds", "sku", "store_id", F.lit(1).alias(anomalies.ISOLATION)
    )
    flagged = anomalies.flag_anomalies(table, anomalies.global_stats(table), busy.union(busy))
    return flagged.select(
        "ds", "sku", "store_id", *anomalies.FLAGS, "anomaly_score", "is_anomaly"
    )
