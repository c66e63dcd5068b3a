"""Feature drift between a reference period and a current period."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions import round_to, snap
from larder.operators.ranks import running_totals
from larder.operators.staging import complete_rows
from larder.session import stage

# Monitored inputs and target. Fixed by the data model.
FEATURES = (
    "day_of_week",
    "month",
    "is_promo",
    "units_sold_lag_7",
    "units_sold_lag_14",
    "units_sold_lag_30",
    "units_sold_roll_mean_7",
    "units_sold_roll_std_7",
    "units_sold_roll_mean_14",
    "units_sold_roll_std_14",
    "units_sold_roll_mean_30",
    "units_sold_roll_std_30",
)
TARGET = "units_sold"

PSI_LIMIT = 0.2
P_VALUE_LIMIT = 0.05
DATASET_LIMIT = 0.3
# Rows of the larger sample up to which a p-value is exact: the switch that scipy's two-sample
# test makes by default. Fixed value.
EXACT_ROWS = 10_000


def periods(
    features: DataFrame,
    cutoff: str,
    start: str | None = None,
    end: str | None = None,
    columns: Sequence[str] = FEATURES,
) -> DataFrame:
    """Complete rows, marked by period; rows in neither period are dropped.

    Reference: before the cutoff. Current: from ``start`` (default: the cutoff) to
    ``end`` inclusive (default: open).
    """
    day = F.col("ds").cast("date")
    reference = day < F.lit(cutoff).cast("date")
    current = day >= F.lit(start or cutoff).cast("date")
    if end is not None:
        current = current & (day <= F.lit(end).cast("date"))
    return (
        complete_rows(features, list(columns))
        .withColumns({"is_reference": reference, "is_current": current})
        .where("is_reference OR is_current")
    )


def period_counts(marked: DataFrame) -> DataFrame:
    return marked.agg(
        F.count_if("is_reference").alias("reference_rows"),
        F.count_if("is_current").alias("current_rows"),
    )


def value_histogram(marked: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, reference, current): occurrences per period, from one scan.

    Values are taken at six decimals: two windows over the same numbers in another
    order may differ in the last float digit, and must still count as one value.
    """
    cells = F.array(
        *(F.struct(F.lit(c).alias("feature"), _number(marked, c).alias("value")) for c in columns)
    )
    return (
        marked.select("is_reference", "is_current", F.inline(cells))
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(
            F.count_if("is_reference").alias("reference"),
            F.count_if("is_current").alias("current"),
        )
    )


def ranked_histogram(marked: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The value histogram with running and total counts of both periods."""
    return running_totals(
        value_histogram(marked, columns),
        ["value"],
        {"reference": "reference", "current": "current"},
        within=["feature"],
    )


def _number(marked: DataFrame, c: str) -> Column:
    """A monitored value as a double, at six decimals where it is a computed one."""
    computed = dict(marked.dtypes)[c] in ("double", "float")
    return snap(c) if computed else F.col(c).cast("double")


def _spans(marked: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, n_reference, n_current, low, high): one row per feature, from one aggregate."""
    summed, rows = [], []
    for i, c in enumerate(columns):
        value = _number(marked, c)
        before = F.col("is_reference") & value.isNotNull()
        summed += [
            F.min(F.when(before, value)).alias(f"low_{i}"),
            F.max(F.when(before, value)).alias(f"high_{i}"),
            F.count_if(before).alias(f"r_{i}"),
            F.count_if(F.col("is_current") & value.isNotNull()).alias(f"c_{i}"),
        ]
        low, high = F.col(f"low_{i}"), F.col(f"high_{i}")
        rows.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"r_{i}").alias("n_reference"),
                F.col(f"c_{i}").alias("n_current"),
                F.when(low == high, low - 0.5).otherwise(low).alias("low"),
                F.when(low == high, high + 0.5).otherwise(high).alias("high"),
            )
        )
    found = marked.agg(*summed).select(F.inline(F.array(*rows)))
    return found.where((F.col("n_reference") > 0) | (F.col("n_current") > 0))


def psi(marked: DataFrame, columns: Sequence[str] = (*FEATURES, TARGET), bins: int = 10) -> DataFrame:
    """Population stability index per feature.

    Equal-width bins span the reference values, the last one closed on the right; a
    constant feature gets a unit-wide span. Current values outside the span fall in
    no bin but stay in the denominator. Counts are smoothed by one. Rows are counted per
    bin before they are shuffled. ``marked`` is read twice: store it first.
    """
    spans = stage(_spans(marked, columns), "spans")
    step = (F.col("high") - F.col("low")) / bins
    passed = [(F.col("value") >= F.col("low") + step * i).cast("int") for i in range(1, bins)]
    cells = F.array(
        *(F.struct(F.lit(c).alias("feature"), _number(marked, c).alias("value")) for c in columns)
    )
    binned = (
        marked.select("is_reference", "is_current", F.inline(cells))
        .join(F.broadcast(spans), "feature")  # one row per monitored column
        .where(F.col("value").between(F.col("low"), F.col("high")))
        .groupBy("feature", sum(passed, F.lit(0)).alias("bin"))
        .agg(F.count_if("is_reference").alias("r"), F.count_if("is_current").alias("c"))
    )
    # Bins without any value are absent above; they contribute through smoothing.
    grid = spans.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))

    def share(count: str, total: str) -> Column:
        return (F.coalesce(F.col(count), F.lit(0)) + 1) / (F.col(total) + bins)

    expected, found = share("r", "n_reference"), share("c", "n_current")
    return (
        grid.join(binned, ["feature", "bin"], "left")
        .groupBy("feature")
        .agg(F.sum((found - expected) * F.log(found / expected)).alias("psi"))
    )


def ks_statistic(ranked: DataFrame) -> DataFrame:
    """Largest distance between the two empirical distributions, per feature.

    NULL where a period has no value: there is no distribution to compare.
    """
    distance = F.abs(
        F.try_divide("reference_through", "reference_total")
        - F.try_divide("current_through", "current_total")
    )
    return ranked.groupBy("feature").agg(
        F.max(distance).alias("ks_statistic"),
        F.max("reference_total").alias("n_reference"),
        F.max("current_total").alias("n_current"),
    )


def asymptotic_p_value(statistic: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value of the two-sample test.

    The Kolmogorov distribution has two series; each is used where it converges
    within a few terms.
    """
    n, m = n.cast("double"), m.cast("double")
    x = F.sqrt(F.try_divide(n * m, n + m)) * statistic
    tail = sum((2.0 * (-1.0) ** (k - 1) * F.exp(-2.0 * k * k * x * x) for k in range(1, 6)), F.lit(0.0))
    body = sum(
        (F.exp(-((2 * k - 1) ** 2) * math.pi**2 / (8.0 * x * x)) for k in range(1, 6)), F.lit(0.0)
    )
    near = 1.0 - math.sqrt(2 * math.pi) / x * body
    p = F.when(x < 0.05, F.lit(1.0)).when(x < 1.0, near).otherwise(tail)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))


def exact_p_value(statistic: float, n: int, m: int) -> float:
    """Chance that two samples of n and m values from one distribution lie so far apart or further.

    A random order of all values is a lattice path from (0, 0) to (n, m); the distance at (i, j)
    is abs(i / n - j / m). Chances flow along the diagonals, and what reaches the distance
    leaves: a sum of positive numbers, without cancellation. Time is n times m.
    """
    if not n or not m or statistic is None or math.isnan(statistic):
        return math.nan
    n, m = min(n, m), max(n, m)
    reached = round(statistic * n * m)  # distances are whole multiples of 1 / (n m)
    if reached <= 0:
        return 1.0
    here = np.zeros(n + 1)  # by i; j is the diagonal's number less i
    here[0], gone = 1.0, 0.0
    i = np.arange(n + 1)
    for k in range(n + m):
        # Only places inside the lattice and the band can hold anything.
        low, high = max(0, k - m), min(n, k)
        at = i[low : high + 1]
        held = here[low : high + 1]
        left = n + m - k
        up = held * (n - at) / left
        here[low : high + 1] = held * (m - k + at) / left
        stop = min(high + 2, n + 1)
        here[low + 1 : stop] += up[: stop - low - 1]
        at = i[low:stop]
        out = np.abs(at * m - (k + 1 - at) * n) >= reached
        part = here[low:stop]
        gone += part[out].sum()
        part[out] = 0.0
    return min(1.0, float(gone))


@F.pandas_udf(T.DoubleType())
def _exact_p_values(statistic: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series(
        [
            None if any(v is None or v != v for v in (d, a, b)) else exact_p_value(d, int(a), int(b))
            for d, a, b in zip(statistic, n, m)
        ],
        dtype=float,
    )


def ks_p_value(statistic: Column, n: Column, m: Column, exact_rows: int = EXACT_ROWS) -> Column:
    """Two-sided p-value of the two-sample test: exact while neither sample exceeds
    ``exact_rows``, asymptotic beyond."""
    small = F.greatest(n, m) <= exact_rows
    exact = _exact_p_values(F.when(small, statistic), n.cast("bigint"), m.cast("bigint"))
    return F.when(small, exact).otherwise(asymptotic_p_value(statistic, n, m))


def drift_report(
    marked: DataFrame,
    columns: Sequence[str] = (*FEATURES, TARGET),
    bins: int = 10,
    psi_limit: float = PSI_LIMIT,
    p_limit: float = P_VALUE_LIMIT,
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """PSI, KS, p-value and verdict per feature.

    P-values are exact while neither period has more than ``exact_rows`` values.

    The monitored columns are stored once; PSI counts bins, KS ranks the value histogram.
    A feature without a value in one of the periods has NULLs, the verdict included, and
    the status 'no data'.
    """
    marked = stage(marked.select("is_reference", "is_current", *columns), "periods")
    ranked = ranked_histogram(marked, columns)
    p = ks_p_value(F.col("ks_statistic"), F.col("n_reference"), F.col("n_current"), exact_rows)
    joined = psi(marked, columns, bins).join(ks_statistic(ranked), "feature")
    known = (F.col("n_reference") > 0) & (F.col("n_current") > 0)
    verdict = F.when(known, (F.col("psi") > psi_limit) | (F.col("p") < p_limit))
    return joined.withColumn("p", p).select(
        "feature",
        round_to(F.when(known, F.col("psi")), 4).alias("psi"),
        round_to("ks_statistic", 4).alias("ks_statistic"),
        round_to("p", 4).alias("ks_pvalue"),
        verdict.alias("drift_detected"),
    )


def drift_status(psi_value: Column) -> Column:
    return (
        F.when(psi_value.isNull(), "no data")
        .when(psi_value < 0.1, "green")
        .when(psi_value < 0.2, "yellow")
        .otherwise("red")
    )


def dataset_drift(report: DataFrame, limit: float = DATASET_LIMIT) -> DataFrame:
    """Share of drifted inputs (the target does not count) and the overall verdict.

    Features without a verdict do not count; if none has one, share and verdict are NULL.
    """
    inputs = report.where(F.col("feature") != TARGET)
    return inputs.agg(
        F.count_if("drift_detected").alias("drifted_features"),
        F.count("drift_detected").alias("features"),
    ).select(
        "drifted_features",
        "features",
        round_to(F.try_divide("drifted_features", "features"), 4).alias("drift_share"),
        (F.try_divide("drifted_features", "features") > limit).alias("dataset_drift"),
    )


SUMMARY = (
    "cutoff string, reference_rows bigint, current_rows bigint, features map<string, struct<psi:"
    " double, ks_statistic: double, ks_pvalue: double, drift_detected: boolean>>, target struct<psi:"
    " double, ks_statistic: double, ks_pvalue: double, drift_detected: boolean>, drifted_features"
    " bigint, drift_share double, dataset_drift boolean"
)


def drift_summary(report: DataFrame, counts: DataFrame, cutoff: str) -> DataFrame:
    """The whole report as one nested row: inputs by name, the target, and the verdict."""
    result = F.struct("psi", "ks_statistic", "ks_pvalue", "drift_detected")
    named = F.when(F.col("feature") != TARGET, F.struct("feature", result.alias("result")))
    nested = report.agg(
        F.map_from_entries(F.sort_array(F.collect_list(named))).alias("features"),  # monitored columns
        F.max(F.when(F.col("feature") == TARGET, result)).alias("target"),
    )
    overall = dataset_drift(report).drop("features")
    return (
        counts.crossJoin(F.broadcast(nested))  # one row each
        .crossJoin(F.broadcast(overall))
        .select(
            F.lit(cutoff).alias("cutoff"), "reference_rows", "current_rows", "features", "target",
            "drifted_features", "drift_share", "dataset_drift",
        )
    )


def retrain_decision(report: DataFrame, limit: float = DATASET_LIMIT) -> DataFrame:
    """'retrain' or 'skip', for a scheduler to act on."""
    action = F.when(F.col("dataset_drift"), "retrain").otherwise("skip")
    return dataset_drift(report, limit).select(action.alias("action"))
