"""Mergeable summaries per day: distinct counts and quantiles of any period without the rows.

A day's state is a few kilobytes whatever the number of its rows. States are stored once and
merged for every period asked for, several periods in one scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRECISION = 12
WIDTH = 400
# Share of rows by which a quantile's rank may be off, at that width, with 99.9 % certainty or more.
RANK_ERROR = 0.012
# Relative error of a distinct count at that precision: three standard errors of 1.04 / sqrt(2^12).
COUNT_ERROR = 0.05


def daily_states(
    df: DataFrame,
    day: str,
    distinct: Sequence[str] = (),
    numbers: Sequence[str] = (),
    precision: int = PRECISION,
    width: int = WIDTH,
) -> DataFrame:
    """(day, rows, <column>_distinct, <column>_ranks): one row per day, from one aggregate.

    NULLs count for nothing. Rows without a day are a state of their own, merged by no period.
    """
    return df.groupBy(F.col(day).cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.hll_sketch_agg(c, precision).alias(f"{c}_distinct") for c in distinct),
        *(F.kll_sketch_agg_double(F.col(c).cast("double"), width).alias(f"{c}_ranks") for c in numbers),
    )


def merged(states: DataFrame, periods: Mapping[str, tuple[str, str]]) -> DataFrame:
    """(period, rows, states): the days of each period, first to last, merged in one scan.

    Periods may overlap; one without a day has no row.
    """
    day = F.col("day")
    inside = F.array(
        *(
            F.when(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")), F.lit(name))
            for name, (first, last) in periods.items()
        )
    )
    of = states.withColumn("period", F.explode(F.array_compact(inside)))
    return of.groupBy("period").agg(
        F.sum("rows").alias("rows"),
        *(F.hll_union_agg(c).alias(c) for c in states.columns if c.endswith("_distinct")),
        *(F.kll_merge_agg_double(c).alias(c) for c in states.columns if c.endswith("_ranks")),
    )


def distinct_count(column: str) -> Column:
    return F.hll_sketch_estimate(f"{column}_distinct")


def quantiles(column: str, shares: Sequence[float]) -> Column:
    """Array of values whose ranks are within ``RANK_ERROR`` of the shares asked for."""
    return F.kll_sketch_get_quantile_double(f"{column}_ranks", F.array(*(F.lit(float(s)) for s in shares)))
