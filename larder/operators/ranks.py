"""Running totals and quantiles that never pass a whole group through one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.session import stage


def _slices(
    df: DataFrame,
    order_by: Sequence[Column | str],
    sums: Mapping[str, str],
    keys: list[str],
) -> tuple[DataFrame, DataFrame]:
    """Rows cut into even slices along the order, and where each slice starts.

    The sliced rows are written once: range boundaries come from a sample, so
    computing them twice could cut the data in two different ways.
    """
    sliced = stage(
        df.repartitionByRange(*keys, *order_by).withColumn("_slice", F.spark_partition_id()),
        "slices",
    )
    slice_sums = sliced.groupBy(*keys, "_slice").agg(*(F.sum(c).alias(n) for n, c in sums.items()))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    starts = slice_sums.select(
        *keys,
        "_slice",
        *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_{n}_before") for n in sums),
        *(F.col(n).alias(f"_{n}_inside") for n in sums),
        *(F.sum(n).over(whole).alias(f"{n}_total") for n in sums),
    )
    return sliced, starts


def _running(sliced, starts, order_by, sums, keys, columns) -> DataFrame:
    inside = (
        Window.partitionBy(*keys, "_slice")
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return sliced.join(starts, [*keys, "_slice"]).select(
        *columns,
        *(
            (F.col(f"_{n}_before") + F.sum(c).over(inside)).alias(f"{n}_through")
            for n, c in sums.items()
        ),
        *(f"{n}_total" for n in sums),
    )


def running_totals(
    df: DataFrame,
    order_by: Sequence[Column | str],
    sums: Mapping[str, str],
    within: Sequence[str] = (),
) -> DataFrame:
    """Cumulative sums over an order, for groups of any size.

    ``sums`` maps an output name to the column it accumulates; for each name the
    result has ``<name>_through`` (up to and including the row) and ``<name>_total``
    (over the group). ``order_by`` must be unique inside a group.

    A plain window would sort each group in one task. Here the rows are
    range-partitioned into even slices, each slice is summed on its own, and the
    slice totals, a few per slice, give the offset at which a slice starts.
    """
    keys = list(within)
    sliced, starts = _slices(df, order_by, sums, keys)
    return _running(sliced, starts, order_by, sums, keys, df.columns)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(measure, value, weight): how often each value of each column occurs."""
    pairs = F.array(
        *(
            F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"))
            for c in columns
        )
    )
    return (
        df.select(F.explode(pairs).alias("p"))
        .select("p.measure", "p.value")
        .where(F.col("value").isNotNull())
        .groupBy("measure", "value")
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float]
) -> DataFrame:
    """One row of interpolated quantiles, named ``<column>_<suffix>``.

    Same result as the built-in ``percentile``, which keeps every distinct value in
    one aggregation buffer; this counts the values in a distributed way and looks
    up the two that surround each rank.
    """
    counts = value_counts(df, columns)
    sums, keys = {"n": "weight"}, ["measure"]
    sliced, starts = _slices(counts, ["value"], sums, keys)

    def rank(p: float) -> Column:
        return F.lit(float(p)) * (F.col("n_total") - 1)

    def covers(start: Column, end: Column, position: Column) -> Column:
        return (start <= position) & (position < end)

    # Only the few slices that contain a wanted rank are ranked row by row.
    first, last = F.col("_n_before"), F.col("_n_before") + F.col("_n_inside")
    needed = [
        covers(first, last, edge(rank(p)))
        for p in probabilities.values()
        for edge in (F.floor, F.ceil)
    ]
    ranked = _running(
        sliced, starts.where(reduce(Column.__or__, needed)), ["value"], sums, keys, counts.columns
    )
    end = F.col("n_through")
    start = end - F.col("weight")
    wanted, results = [], []
    for column in columns:
        mine = F.col("measure") == column
        for suffix, p in probabilities.items():
            name = f"{column}_{suffix}"
            position = rank(p)
            lower = F.floor(position)
            for part, edge in (("lo", lower), ("hi", F.ceil(position))):
                found = F.when(mine & covers(start, end, edge), F.col("value"))
                wanted.append(F.max(found).alias(f"{name}_{part}"))
            wanted.append(F.max(F.when(mine, position - lower)).alias(f"{name}_part"))
            low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
            results.append((low + (high - low) * F.col(f"{name}_part")).alias(name))
    return ranked.agg(*wanted).select(*results)


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float], accuracy: int = 10000
) -> DataFrame:
    """The same row from sketches: one pass, bounded memory, rank error 1/accuracy."""
    return df.agg(
        *(
            F.percentile_approx(c, p, accuracy).cast("double").alias(f"{c}_{suffix}")
            for c in columns
            for suffix, p in probabilities.items()
        )
    )
