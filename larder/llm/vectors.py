"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.buckets import block_pairs, map_cells
from larder.llm.components import components, smallest_links
from larder.session import stage

COSINE = 0.95
WINDOW = 128
MISS = 1e-3
HASHES = 63
STRIP = 512


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: finite components, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def prefix_bits(rows: int, window: int = WINDOW) -> int:
    """Leading hashes that tell rows / window groups apart."""
    return min(HASHES, max(0, math.ceil(math.log2(max(1, rows) / window))))


def passes_needed(rows: int, cosine: float, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold is missed with probability ``miss``.

    One random hash differs with probability angle / pi. In a pass, vectors that agree on the
    leading ``prefix_bits`` hashes are compared, however many they are. Closer pairs are missed
    far less often.
    """
    agree = 1 - math.acos(cosine) / math.pi
    meet = agree ** prefix_bits(rows, window)
    return 1 if meet >= 1 else math.ceil(math.log(miss) / math.log1p(-meet))


@lru_cache(maxsize=8)
def _planes(seed: int, passes: int, width: int) -> np.ndarray:
    return np.random.default_rng([seed, width]).standard_normal((width, passes * HASHES))


def _unit_rows(vectors: pa.ListArray) -> list[np.ndarray]:
    """Vectors of an Arrow column as unit rows of double precision."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    edges = np.concatenate([[0], np.cumsum(vectors.value_lengths().to_numpy())])
    rows = [flat[a:b] for a, b in zip(edges, edges[1:])]
    rows = [r / np.abs(r).max() for r in rows]  # so that squares neither overflow nor vanish
    return [r / math.sqrt(r @ r) for r in rows]


def project(nodes: DataFrame, passes: int, seed: int, vectors: bool = True) -> DataFrame:
    """(width, pass, key, node, vector): each vector under the sort key of every pass.

    Without ``vectors`` only (width, pass, key), to count keys by. A key is the signs of a vector's products with random directions, one bit each, the
    first one highest: keys in order are the concatenated hashes in lexicographic order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.int64(1) << np.arange(HASHES - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, STRIP):
                part = batch.slice(start, STRIP)
                units = _unit_rows(part.column("vector"))
                keys = np.zeros((len(units), passes), np.int64)
                widths = np.array([len(u) for u in units], np.int64)
                for width in np.unique(widths):
                    mine = np.flatnonzero(widths == width)
                    signs = np.stack([units[i] for i in mine]) @ _planes(seed, passes, int(width)) > 0
                    keys[mine] = signs.reshape(len(mine), passes, HASHES) @ weights
                rest = ["node", "vector"] if vectors else []
                for number in range(passes):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(widths),
                            pa.array(np.full(len(units), number)),
                            pa.array(np.ascontiguousarray(keys[:, number])),
                            *(part.column(c) for c in rest),
                        ],
                        names=["width", "pass", "key", *rest],
                    )

    kind = nodes.schema["vector"].dataType.simpleString()
    rest = f", node bigint, vector {kind}" if vectors else ""
    return nodes.select("node", "vector").mapInArrow(run, f"width bigint, pass bigint, key bigint{rest}")


GROUP = ["width", "pass", "prefix"]


def with_prefix(projected: DataFrame, bits: int) -> DataFrame:
    return projected.withColumn("prefix", F.shiftright("key", HASHES - bits))


def found_links(
    nodes: DataFrame, passes: int, bits: int, seed: int, cosine: float, window: int = WINDOW
) -> DataFrame:
    """(a, b): verified pairs of all passes.

    Vectors that share a pass's prefix are all compared: by the window, which no group of
    that size outgrows, or, where a dense region puts more of them under one prefix, all with
    all in blocks. So how densely vectors lie costs time and loses no link.
    """
    counted = with_prefix(project(nodes, passes, seed, vectors=False), bits)
    sizes = counted.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"))
    dense = stage(sizes.where(F.col("n") > window).select(*GROUP), "dense")
    projected = with_prefix(project(nodes, passes, seed), bits)
    if dense.isEmpty():
        return window_links(projected, cosine, window)
    thin = projected.join(dense, GROUP, "left_anti")
    thick = stage(
        projected.join(dense, GROUP, "left_semi").select(F.struct(*GROUP).alias("crowd"), "node", "vector"),
        "crowds",
    )
    return window_links(thin, cosine, window).union(crowd_links(thick, cosine))


def crowd_links(members: DataFrame, cosine: float) -> DataFrame:
    """(a, b): verified pairs of the members of each crowd, compared in blocks of bounded size."""

    def work(cells: np.ndarray, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        units = _unit_rows(rows.column("vector"))
        nodes, sides = rows.column("node").to_numpy(), rows.column("side").to_numpy()
        edges = np.flatnonzero(np.diff(cells)) + 1
        for low, high in zip([0, *edges], [*edges, len(cells)]):
            mine = np.arange(low, high)
            first, second = mine[sides[low:high] == 0], mine[sides[low:high] == 1]
            second = second if len(second) else first
            right = np.stack([units[i] for i in second])
            found_a, found_b = [], []
            for start in range(0, len(first), STRIP):
                strip = first[start : start + STRIP]
                x, y = np.nonzero(np.stack([units[i] for i in strip]) @ right.T >= cosine)
                found_a.append(strip[x] - low)
                found_b.append(second[y] - low)
            if found_a:
                yield from smallest_links(nodes[mine], np.concatenate(found_a), np.concatenate(found_b))

    cells = block_pairs(members, "crowd", "node")
    return map_cells(cells, ["side", "node", "vector"], work, "a bigint, b bigint")


def window_links(projected: DataFrame, cosine: float, window: int = WINDOW) -> DataFrame:
    """(a, b): verified pairs among neighbours of the sorted order of each pass.

    Rows are range-partitioned by pass and prefix, so that no edge parts a prefix, and sorted
    by key; every row is compared with the ``window`` rows after it, in double precision. Of the
    pairs found in a batch a star per connected group goes on, so a crowd of near-equal vectors
    gives a link per vector.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tail_nodes, tail_units = None, np.zeros(0, np.int64), None
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            series = np.stack([batch.column("width").to_numpy(), batch.column("pass").to_numpy()])
            units = _unit_rows(batch.column("vector"))
            cuts = np.flatnonzero((series[:, 1:] != series[:, :-1]).any(axis=0)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(nodes)]):
                if low == high:
                    continue
                now, part, these = tuple(series[:, low]), np.stack(units[low:high]), nodes[low:high]
                if now == held:
                    part = np.concatenate([tail_units, part])
                    these = np.concatenate([tail_nodes, these])
                yield from compare(these, part)
                held, tail_nodes, tail_units = now, these[-window:], part[-window:]

    def compare(nodes: np.ndarray, units: np.ndarray) -> Iterator[pa.RecordBatch]:
        found_a, found_b = [], []
        for start in range(0, len(nodes), STRIP):
            left = units[start : start + STRIP]
            right = units[start : start + STRIP + window]
            x, y = np.nonzero(left @ right.T >= cosine)
            near = (y > x) & (y <= x + window)
            found_a.append(x[near] + start)
            found_b.append(y[near] + start)
        yield from smallest_links(nodes, np.concatenate(found_a), np.concatenate(found_b))

    return (
        projected.repartitionByRange(*GROUP)
        .sortWithinPartitions("width", "pass", "key", "node")
        .select("width", "pass", "node", "vector")
        .mapInArrow(run, "a bigint, b bigint")
    )


def link_counts(members: DataFrame, cosine: float) -> DataFrame:
    """(node, links): vectors that each vector of a component is linked to, copies counted.

    ``members`` has component, node, vector and copies. All vectors of a component are
    compared, in blocks of bounded size; only counts leave a block.
    """

    def work(cells: np.ndarray, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        units = _unit_rows(rows.column("vector"))
        nodes, copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
        sides = rows.column("side").to_numpy()
        links = np.zeros(len(nodes), np.int64)
        edges = np.flatnonzero(np.diff(cells)) + 1
        for low, high in zip([0, *edges], [*edges, len(cells)]):
            mine = np.arange(low, high)
            first, second = mine[sides[low:high] == 0], mine[sides[low:high] == 1]
            alone = not len(second)
            second = first if alone else second
            right = np.stack([units[i] for i in second])
            for start in range(0, len(first), STRIP):
                strip = first[start : start + STRIP]
                near = np.stack([units[i] for i in strip]) @ right.T >= cosine
                if alone:  # a vector is no link of its own
                    near[np.arange(len(strip)), start + np.arange(len(strip))] = False
                links[strip] += near @ copies[second]
                if not alone:
                    links[second] += copies[strip] @ near
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(links)], names=["node", "links"])

    cells = block_pairs(members, "component", "node")
    parts = map_cells(
        cells, ["side", "node", "vector", "copies"], work, "node bigint, links bigint"
    )
    return parts.groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicate_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    window: int = WINDOW,
    miss: float = MISS,
    seed: int = 7,
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Vectors link at a cosine of ``cosine`` or more, in double precision. Vectors that are
    NULL, empty, zero or hold NULL or non-finite components link with nothing, and so do
    vectors of different length. Equal vectors are one node with a number of copies.
    Sorted passes find the components; inside a component all pairs are then compared, so
    ``n_links`` counts every link, and none below the threshold is made. A link that alone
    joins two components is missed with probability ``miss`` at most if it lies at the
    threshold, also in a dense region: what shares a prefix there is compared in blocks, at the
    cost of the square of its number. ``component_id`` is the smallest id reachable, the vector's own included,
    ``kept`` whether it is its own; rows repeated under one id are rows of their own, and a
    NULL id is the component's only if it has no other. An empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    rows = stage(rows.withColumn("usable", usable(F.col("vector"))), "vectors")
    nodes = stage(
        rows.where("usable")
        .groupBy("vector")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    count = nodes.count()
    passes, bits = passes_needed(count, cosine, window, miss), prefix_bits(count, window)
    found = components(found_links(nodes, passes, bits, seed, cosine, window))
    linked = stage(nodes.join(found, "node"), "linked")
    counts = link_counts(linked.select("component", "node", "vector", "copies"), cosine)
    lowest = linked.groupBy("component").agg(F.min("first").alias("lowest"))
    named = stage(
        nodes.join(linked.select("node", "component"), "node", "left")
        .join(lowest, "component", "left")
        .join(counts, "node", "left")
        .select(
            "vector",
            F.coalesce("lowest", "first").alias("component_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "named",
    )
    shared = rows.where("usable").join(named, "vector").select("id", "n_links", "component_id")
    alone = rows.where(~F.col("usable")).select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    return shared.union(alone).select(
        F.col("id").alias(id_col),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
