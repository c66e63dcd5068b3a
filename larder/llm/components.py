"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import stage


def _signature(edges: DataFrame):
    """Count and order-free checksum of a set of edges."""
    return edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    return (
        both.where(F.col("b") > F.col("a"))
        .join(lowest, "a")
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    lowest = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(lowest, "a").where(F.col("b") != F.col("low"))
    return (
        moved.select(F.col("b").alias("a"), F.col("low").alias("b"))
        .union(lowest.select("a", F.col("low").alias("b")))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node each linked node can reach, itself included.

    ``edges`` has the columns a and b, of one type with an order; direction and repeats do
    not matter. Nodes without links do not appear. Each round halves paths at least; it is
    made of joins and aggregates whose hot keys have one row on one side, which adaptive
    execution splits. The links of a round are written to the shared folder, so that lost
    executors cost one round and plans do not grow. Nothing but a count and a checksum
    reaches the driver.
    """
    clean = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now = stage(clean.distinct(), "links")
    mark = _signature(now)
    while mark[0]:
        large = stage(_large_star(now), "links")
        after = stage(_small_star(large), "links")
        changed = _signature(after)
        now = after
        if changed == mark:
            break
        mark = changed
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def labels(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row reachable over links a-b, for each of ``count`` rows."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if np.array_equal(label, before):
            return label


def smallest_links(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Links (a, b) from each of ``nodes`` that the row links a-b connect to one of its group.

    A group of n connected rows gives n - 1 links, however many pairs were found in it.
    """
    label = labels(len(nodes), a, b)
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    if len(linked):
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[linked]), pa.array(nodes[label[linked]])], names=["a", "b"]
        )
