"""Forecast accuracy. Input frames hold ``actual`` and ``pred`` per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions import ratio, round_to

LOWER_IS_BETTER = ("wape", "mae", "rmse", "mase")


def _partial_sums() -> dict[str, Column]:
    """Everything the metrics need, as plain sums that merge between tasks."""
    y, yhat = F.col("actual"), F.col("pred")
    error = F.abs(y - yhat)
    relative = F.try_divide(error, y.cast("double"))
    size = F.abs(y) + F.abs(yhat)

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0.0))

    return {
        "rows": F.count(F.lit(1)),
        "y": F.sum(y),
        "yhat": F.sum(yhat),
        "error": F.sum(error),
        "square": F.sum(error * error),
        "positive": F.count_if(y > 0),
        "hit_20": F.count_if((y > 0) & (relative <= 0.2)),
        "hit_10": F.count_if((y > 0) & (relative <= 0.1)),
        "sized": F.count_if(size > 0),
        "smape": total(F.when(size > 0, F.try_divide(error * 2, size))),
        "nonzero": F.count_if(y != 0),
        "mape": total(F.when(y != 0, F.abs(relative))),
    }


def _metrics_from_sums() -> list[Column]:
    """Metrics from the summed columns; NULL where the definition divides by zero."""
    c = {name: F.col(f"_{name}") for name in (*_partial_sums(), "steps")}
    positive_total = F.when(c["y"] > 0, c["y"])
    naive = ratio(c["steps"], c["rows"] - 1)

    def share(part: str, whole: str, places: int) -> Column:
        return round_to(ratio(c[part], c[whole]) * 100, places).alias(part)

    return [
        c["rows"].alias("n_records"),
        c["y"].alias("total_actual"),
        round_to(ratio(c["error"], c["rows"]), 2).alias("mae"),
        round_to(F.sqrt(ratio(c["square"], c["rows"])), 2).alias("rmse"),
        round_to(ratio(c["error"], positive_total) * 100, 2).alias("wape"),
        round_to(ratio(c["yhat"] - c["y"], positive_total) * 100, 2).alias("bias"),
        round_to(ratio(ratio(c["error"], c["rows"]), naive), 3).alias("mase"),
        share("hit_20", "positive", 1).alias("hit_rate_20"),
        share("hit_10", "positive", 1).alias("hit_rate_10"),
        share("smape", "sized", 2),
        share("mape", "nonzero", 2),
    ]


def evaluate(
    df: DataFrame,
    by: Sequence[str] = (),
    order: Sequence[str] = ("ds",),
    min_rows: int = 1,
) -> DataFrame:
    """All metrics per group in one pass, MASE included.

    MASE scales the error by the mean step of ``actual`` along ``order``, which must
    identify the rows of a group. The group may be any share of the data, so it is
    never sorted as a whole: the steps of the innermost order column are taken first,
    then each run is reduced to its sums and its first and last value, and the runs
    are linked one order column further out. A window thus sees at most one row per
    value of one order column.
    """
    keys, sums = list(by), _partial_sums()
    rows, first, last = df, "actual", "actual"
    for depth in reversed(range(len(order))):
        outer, inner = [*keys, *order[:depth]], order[depth]
        run = Window.partitionBy(*outer).orderBy(inner)
        link = F.coalesce(F.abs(F.col(first) - F.lag(last).over(run)), F.lit(0.0))
        if rows is df:
            merged = [c.alias(f"_{name}") for name, c in sums.items()]
            steps = F.sum("_link")
        else:
            merged = [F.sum(f"_{name}").alias(f"_{name}") for name in sums]
            steps = F.sum("_link") + F.sum("_steps")
        rows = (
            rows.withColumn("_link", link)
            .groupBy(*outer)
            .agg(
                *merged,
                steps.alias("_steps"),
                F.min_by(first, inner).alias("_first"),
                F.max_by(last, inner).alias("_last"),
            )
        )
        first, last = "_first", "_last"
    return rows.where(F.col("_rows") >= min_rows).select(*keys, *_metrics_from_sums())


def daily_totals(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Actual and predicted totals per day."""
    return predictions.groupBy(*by, "ds").agg(
        F.sum("actual").alias("actual"), F.sum("pred").alias("pred")
    )


def evaluate_daily(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Metrics of the daily totals, the grain at which models are compared."""
    return evaluate(daily_totals(predictions, by), by)


def evaluate_by(
    predictions: DataFrame,
    key: str,
    segments: DataFrame | None = None,
    min_rows: int = 5,
    by: Sequence[str] = (),
) -> DataFrame:
    """Metrics per product or store, and per ``by`` (models, say); groups of fewer than
    ``min_rows`` are left out."""
    other = "store_id" if key == "sku" else "sku"
    measured = evaluate(predictions, [*by, key], ("ds", other), min_rows)
    if segments is None:
        return measured
    known = [c for c in ("forecastable", "abc_class") if c in segments.columns]
    return measured.join(
        segments.select(key, *known, round_to("cv", 2).alias("cv")), key, "left"
    )


def as_predictions(
    features: DataFrame, candidates: Mapping[str, str], actual: str = "units_sold"
) -> DataFrame:
    """One row per (model, series, day) from several prediction columns, in one scan."""
    pairs = F.array(
        *(
            F.struct(F.lit(model).alias("model"), F.col(c).cast("double").alias("pred"))
            for model, c in candidates.items()
        )
    )
    return features.select(
        "ds", "sku", "store_id", F.col(actual).cast("double").alias("actual"), F.inline(pairs)
    )


def compare_models(predictions: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """The comparison table: one row per model, best WAPE first.

    ``kinds`` gives each model's type; 'ML' models predict single series, others
    only totals.
    """
    kind = F.coalesce(*(F.when(F.col("model") == m, F.lit(k)) for m, k in kinds.items()))
    return (
        evaluate_daily(predictions, ["model"])
        .select(
            "model",
            kind.alias("type"),
            *("mae", "rmse", "wape", "bias", "mase", "hit_rate_20", "hit_rate_10", "smape"),
        )
        .orderBy("wape", "model")
    )


def best_model(comparison: DataFrame, metric: str = "wape", kind: str = "ML") -> DataFrame:
    """The winning row among models of one type; ties go to the first name."""
    rows = F.struct(*comparison.columns)
    score = F.col(metric) if metric in LOWER_IS_BETTER else -F.col(metric)
    eligible = comparison.where((F.col("type") == kind) & F.col(metric).isNotNull())
    return eligible.agg(F.min_by(rows, F.struct(score, F.col("model"))).alias("best")).select(
        "best.*"
    )


def validation_gate(
    metrics: DataFrame, limits: Mapping[str, float] | None = None
) -> DataFrame:
    """Promotion checks per model: metrics exist and stay below their limits."""
    bounds = {"rmse": 100.0, "mape": 50.0} if limits is None else limits
    known = [c for c in bounds if c in metrics.columns]
    present = F.coalesce(*(F.col(c).isNotNull() for c in known)) if known else F.lit(False)
    checks = {"has_metrics": present}
    checks |= {f"{c}_threshold": F.coalesce(F.col(c) < bounds[c], F.lit(False)) for c in known}
    passed = F.lit(True)
    for check in checks.values():
        passed = passed & check
    return metrics.select(
        "model", *(c.alias(n) for n, c in checks.items()), passed.alias("all_passed")
    )


def median_by_segment(
    by_group: DataFrame, segment_column: str, by: Sequence[str] = ()
) -> DataFrame:
    """Median WAPE and bias per segment, and per ``by``.

    Both metrics carry two decimals, so the counts behind an exact median stay small.
    """
    return by_group.groupBy(*by, segment_column).agg(
        F.count(F.lit(1)).alias("n"),
        round_to(F.median("wape"), 4).alias("median_wape"),
        round_to(F.median("bias"), 4).alias("median_bias"),
        F.sum("total_actual").alias("total_actual"),
    )


def highest_impact(by_sku: DataFrame, limit: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """Forecastable items whose error weighs most: WAPE times volume; the first of each ``by``."""
    weighed = by_sku.where("forecastable").withColumn("impact", F.col("wape") * F.col("total_actual"))
    columns = [*by, "sku", "wape", "bias", "total_actual", "impact"]
    if not by:
        return weighed.orderBy(F.desc("impact"), "sku").limit(limit).select(columns)
    order = Window.partitionBy(*by).orderBy(F.desc("impact"), "sku")
    ranked = weighed.withColumn("_place", F.row_number().over(order))
    return ranked.where(F.col("_place") <= limit).select(columns)


def prediction_stats(scored: DataFrame) -> DataFrame:
    """WAPE and bias of a scored feature table."""
    y, yhat = F.col("units_sold"), F.col("predicted_demand")
    total = F.sum(y)
    return scored.agg(
        round_to(ratio(F.sum(F.abs(y - yhat)), total) * 100, 2).alias("wape"),
        round_to(ratio(F.sum(yhat) - total, total) * 100, 2).alias("bias"),
    )
