"""Drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import round_to
from larder.operators import drift
from larder.operators.ranks import running_totals
from larder.plans.registry import query, r, view

CUTOFF = "2000-06-01"
COLUMNS = (*drift.FEATURES, drift.TARGET)

_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in drift.FEATURES)
view(
    "marked",
    f"""SELECT *, ds < DATE '{CUTOFF}' AS is_reference, ds >= DATE '{CUTOFF}' AS is_current
    FROM features WHERE {_COMPLETE}""",
)


def _value(column: str) -> str:
    number = "CAST(is_promo AS INTEGER)" if column == "is_promo" else column
    return r(f"CAST({number} AS DOUBLE)", 6)


view(
    "cells",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {_value(c)} AS value, is_reference, is_current FROM marked"
        for c in COLUMNS
    ),
)
view(
    "histogram",
    """SELECT feature, value, COUNT(*) FILTER (WHERE is_reference) AS reference,
      COUNT(*) FILTER (WHERE is_current) AS current FROM cells GROUP BY feature, value""",
)
view(
    "spans",
    """SELECT feature, n_reference, n_current,
      CASE WHEN low = high THEN low - 0.5 ELSE low END AS low,
      CASE WHEN low = high THEN high + 0.5 ELSE high END AS high
    FROM (SELECT feature, MIN(value) FILTER (WHERE reference > 0) AS low,
        MAX(value) FILTER (WHERE reference > 0) AS high, SUM(reference) AS n_reference,
        SUM(current) AS n_current FROM histogram GROUP BY feature)""",
)
_BIN = " + ".join(f"CAST(value >= low + (high - low) / 10 * {i} AS INTEGER)" for i in range(1, 10))
view(
    "psi_table",
    f"""SELECT feature, SUM((c - e) * LN(c / e)) AS psi FROM (
      SELECT g.feature, (COALESCE(b.r, 0) + 1) / CAST(n_reference + 10 AS DOUBLE) AS e,
        (COALESCE(b.c, 0) + 1) / CAST(n_current + 10 AS DOUBLE) AS c
      FROM (SELECT feature, n_reference, n_current, UNNEST(range(0, 10)) AS bin FROM spans) g
      LEFT JOIN (SELECT h.feature, {_BIN} AS bin, SUM(reference) AS r, SUM(current) AS c
        FROM histogram h JOIN spans s ON h.feature = s.feature
        WHERE value BETWEEN low AND high GROUP BY 1, 2) b
      ON g.feature = b.feature AND g.bin = b.bin) GROUP BY feature""",
)
view(
    "ks_table",
    """SELECT feature, MAX(ABS(r / n_reference - c / n_current)) AS ks,
      CAST(MAX(n_reference) AS DOUBLE) AS n, CAST(MAX(n_current) AS DOUBLE) AS m
    FROM (SELECT feature,
        CAST(SUM(reference) OVER (PARTITION BY feature ORDER BY value) AS DOUBLE) AS r,
        CAST(SUM(current) OVER (PARTITION BY feature ORDER BY value) AS DOUBLE) AS c,
        CAST(SUM(reference) OVER (PARTITION BY feature) AS DOUBLE) AS n_reference,
        CAST(SUM(current) OVER (PARTITION BY feature) AS DOUBLE) AS n_current
      FROM histogram) GROUP BY feature""",
)
_TAIL = " + ".join(f"{2 * (-1) ** (k - 1)} * EXP(-2.0 * {k * k} * x * x)" for k in range(1, 6))
_BODY = " + ".join(f"EXP(-{(2 * k - 1) ** 2} * PI() * PI() / (8.0 * x * x))" for k in range(1, 6))
view(
    "drift_table",
    f"""SELECT feature, {r("psi", 4)} AS psi, {r("ks", 4)} AS ks_statistic, {r("p", 4)} AS ks_pvalue,
      psi > 0.2 OR p < 0.05 AS drift_detected
    FROM (SELECT feature, psi, ks, GREATEST(0, LEAST(1, CASE WHEN x < 0.05 THEN 1
        WHEN x < 1 THEN 1 - SQRT(2 * PI()) / x * ({_BODY}) ELSE {_TAIL} END)) AS p
      FROM (SELECT t.feature, psi, ks, SQRT(n * m / (n + m)) * ks AS x
        FROM psi_table t JOIN ks_table k ON t.feature = k.feature))""",
)


def _marked(w):
    return drift.periods(w.features, CUTOFF)


def _report(w):
    """The report with asymptotic p-values for samples of any size, so that SQL can follow."""
    return drift.drift_report(_marked(w), exact_rows=0)


@query(
    "drift_periods",
    "P10 P7",
    """SELECT COUNT(*) FILTER (WHERE is_reference) AS reference_rows,
      COUNT(*) FILTER (WHERE is_current) AS current_rows FROM marked""",
)
def _(w):
    return drift.period_counts(_marked(w))


@query("psi", "X1", f"SELECT feature, {r('psi', 6)} AS psi FROM psi_table")
def _(w):
    from larder.session import stage

    marked = stage(_marked(w).select("is_reference", "is_current", *COLUMNS), "periods")
    return drift.psi(marked, COLUMNS).select("feature", round_to("psi", 6).alias("psi"))


@query("ks_statistic", "X2", f"SELECT feature, {r('ks', 6)} AS ks_statistic FROM ks_table")
def _(w):
    found = drift.ks_statistic(drift.ranked_histogram(_marked(w), COLUMNS))
    return found.select("feature", round_to("ks_statistic", 6).alias("ks_statistic"))


@query("drift_report", "X3 X4 X1 X2", "SELECT * FROM drift_table")
def _(w):
    return _report(w)


@query("drift_report_exact", "X3 X4")
def _(w):
    return drift.drift_report(_marked(w))


@query(
    "drift_status",
    "P17",
    f"""SELECT feature, CASE WHEN psi < 0.1 THEN 'green' WHEN psi < 0.2 THEN 'yellow' ELSE 'red' END
      AS status FROM drift_table""",
)
def _(w):
    report = _report(w)
    return report.select("feature", drift.drift_status(F.col("psi")).alias("status"))


view(
    "monthly_samples",
    f"""SELECT store_id, CAST(SUM(units_sold) AS BIGINT) AS value, month < DATE '{CUTOFF}' AS before
    FROM (SELECT store_id, units_sold, CAST(date_trunc('month', ds) AS DATE) AS month FROM features)
    GROUP BY store_id, month""",
)


@query(
    "exact_ks",
    "X3 X2",
    f"""SELECT store_id, n, m, {r("h / CAST(n * m AS DOUBLE)", 6)} AS ks_statistic, {r("gone", 6)} AS p
    FROM (WITH RECURSIVE
      sizes AS MATERIALIZED (SELECT store_id, COUNT(*) FILTER (WHERE before) AS n,
        COUNT(*) FILTER (WHERE NOT before) AS m FROM monthly_samples GROUP BY store_id),
      apart AS MATERIALIZED (SELECT a.store_id, n, m, MAX(ABS(
          (SELECT COUNT(*) FROM monthly_samples b WHERE b.store_id = a.store_id AND before AND b.value <= a.value) * m
          - (SELECT COUNT(*) FROM monthly_samples b WHERE b.store_id = a.store_id AND NOT before
            AND b.value <= a.value) * n)) AS h
        FROM monthly_samples a JOIN sizes s ON a.store_id = s.store_id
        WHERE n > 0 AND m > 0 GROUP BY a.store_id, n, m),
      paths AS (
        SELECT store_id, n, m, h, 0::BIGINT AS k, list_transform(range(0, n + 1),
          lambda i: CASE WHEN i = 0 THEN 1::DOUBLE ELSE 0::DOUBLE END) AS here, 0::DOUBLE AS gone FROM apart
        UNION ALL
        SELECT store_id, n, m, h, k + 1, list_transform(next, lambda p, j:
            CASE WHEN ABS((j - 1) * m - (k + 1 - (j - 1)) * n) >= h THEN 0::DOUBLE ELSE p END),
          gone + list_sum(list_transform(next, lambda p, j:
            CASE WHEN ABS((j - 1) * m - (k + 1 - (j - 1)) * n) >= h THEN p ELSE 0::DOUBLE END))
        FROM (SELECT *, list_transform(here, lambda p, j: p * (m - k + j - 1) / (n + m - k)
            + CASE WHEN j > 1 THEN here[j - 1] * (n - (j - 2)) / (n + m - k) ELSE 0 END) AS next
          FROM paths WHERE k < n + m))
      SELECT * FROM paths WHERE k = n + m)""",
)
def _(w):
    # Monthly units of each store before and after the cutoff: samples small enough to be exact.
    month = F.trunc("ds", "month")
    samples = (
        w.sold.groupBy("store_id", month.alias("month"))
        .agg(F.sum("units_sold").alias("value"))
        .withColumn("is_reference", F.col("month") < F.lit(CUTOFF).cast("date"))
    )
    counted = samples.groupBy(F.col("store_id").alias("feature"), "value").agg(
        F.count_if("is_reference").alias("reference"), F.count_if(~F.col("is_reference")).alias("current")
    )
    sums = {"reference": "reference", "current": "current"}
    found = drift.ks_statistic(running_totals(counted, ["value"], sums, within=["feature"]))
    p = drift.ks_p_value(F.col("ks_statistic"), F.col("n_reference"), F.col("n_current"))
    return found.where("n_reference > 0 AND n_current > 0").select(
        F.col("feature").alias("store_id"),
        F.col("n_reference").alias("n"),
        F.col("n_current").alias("m"),
        round_to("ks_statistic", 6).alias("ks_statistic"),
        round_to(p, 6).alias("p"),
    )


SHARE = "COUNT(*) FILTER (WHERE drift_detected) / CAST(COUNT(*) AS DOUBLE)"


@query(
    "dataset_drift",
    "X5",
    f"""SELECT COUNT(*) FILTER (WHERE drift_detected) AS drifted_features, COUNT(*) AS features,
      {r(SHARE, 4)} AS drift_share, {SHARE} > 0.3 AS dataset_drift
    FROM drift_table WHERE feature <> 'units_sold'""",
)
def _(w):
    return drift.dataset_drift(_report(w))


@query(
    "retrain_decision",
    "X6",
    f"""SELECT CASE WHEN {SHARE} > 0.3 THEN 'retrain' ELSE 'skip' END AS action
    FROM drift_table WHERE feature <> 'units_sold'""",
)
def _(w):
    return drift.retrain_decision(_report(w))


@query(
    "drift_without_data",
    "X2 X3 X4 P17",
    "SELECT feature, 'no data' AS status, NULL::BOOLEAN AS drift_detected FROM cells GROUP BY feature",
)
def _(w):
    report = drift.drift_report(drift.periods(w.features, "2030-01-01"))
    return report.select(
        "feature", drift.drift_status(F.col("psi")).alias("status"), "drift_detected"
    )
