"""Gradient boosting on histograms of binned inputs.

Rows are binned once and packed in blocks; a level of a tree is one Spark aggregate of
gradient and Hessian sums per node, input and bin, and splits are chosen from those sums.
Sums are taken in whole numbers, so a fit does not depend on how rows are spread, and of two
children only the smaller one is summed: the other one is what the parent has beyond it.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from larder.operators.models import INPUTS, TARGET, error_columns, non_negative
from larder.session import fresh_path, stage

# Rows of a block; a block is the unit that tasks read and keep.
BLOCK = 1 << 16
# Trees after which the running predictions are written, so that lineages stay short.
STORE_EVERY = 20
# Tasks up to which a level's sums go to the driver as they are.
DIRECT = 32
# A block of rows: ids, bins (a row per input), targets, running predictions.
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
# Sums of gradients and Hessians where there are rows: slots, gradients, Hessians.
Sums = tuple[np.ndarray, np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Settings:
    """A booster: ``rows`` and ``columns`` are the shares that each tree sees.

    ``l2`` is added to Hessian sums in leaf values and gains, ``least_hessian`` is the least
    sum on either side of a split, ``accuracy`` that of the quantiles behind the bins.
    """

    rounds: int = 200
    depth: int = 6
    rate: float = 0.1
    rows: float = 0.8
    columns: float = 0.8
    bins: int = 64
    l2: float = 1.0
    least_hessian: float = 1.0
    accuracy: int = 10_000
    seed: int = 42


@dataclass
class Tree:
    """A tree in heap order; ``feature`` is -1 at leaves and where there is no node."""

    feature: np.ndarray
    cut: np.ndarray  # the last bin that goes left
    value: np.ndarray

    def leaves(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node that each row stands in after ``levels`` splits; ``bins`` by input and row."""
        count = bins.shape[1]
        at = np.zeros(count, np.int64)
        rows, flat = np.arange(count), bins.reshape(-1)
        for _ in range(levels):
            feature = self.feature[at]
            goes = feature >= 0
            if not goes.any():
                break
            right = flat[np.maximum(feature, 0) * count + rows] > self.cut[at]
            at = np.where(goes, 2 * at + 1 + right, at)
        return at


@dataclass
class Booster:
    inputs: tuple[str, ...]
    edges: list[np.ndarray]
    base: float
    depth: int
    trees: list[Tree] = field(default_factory=list)
    gains: np.ndarray | None = None
    jobs: list[int] = field(default_factory=list)  # Spark jobs of each tree

    def binned(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """Bin numbers by input and row; a value belongs to the first bin whose edge is not below it."""
        return np.stack(
            [np.searchsorted(e, c, side="left").astype(np.uint8) for e, c in zip(self.edges, columns)]
        )

    def add_up(self, bins: np.ndarray, start: np.ndarray, first: int = 0) -> np.ndarray:
        total = start.copy()
        for tree in self.trees[first:]:
            total += tree.value[tree.leaves(bins, self.depth)]
        return total

    def importance(self) -> list[tuple[str, float]]:
        """(input, share of all gains), most important first."""
        total = self.gains.sum()
        shares = self.gains / total if total else self.gains
        return sorted(zip(self.inputs, map(float, shares)), key=lambda p: (-p[1], p[0]))


def bin_edges(rows: DataFrame, inputs: Sequence[str], settings: Settings) -> list[np.ndarray]:
    """Distinct quantiles of each input, from one aggregate of bounded sketches."""
    if settings.bins > 256:
        raise ValueError("a bin number has to fit one byte")
    shares = [i / settings.bins for i in range(1, settings.bins)]
    found = rows.agg(
        *(F.percentile_approx(F.col(c).cast("double"), shares, settings.accuracy).alias(c) for c in inputs)
    ).first()
    return [np.unique(np.array(found[c] or [], float)) for c in inputs]


def packed(rows: DataFrame, booster: Booster, target: str, keys: Sequence[str]) -> DataFrame:
    """(n, ids, bins, target): blocks of rows as binary columns.

    ``ids`` are hashes of the key columns; which rows a tree sees follows from them.
    """
    columns = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(booster.inputs)]
    plain = rows.select(
        F.xxhash64(*keys).alias("id"), F.col(target).cast("double").alias("y"), *columns
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def out() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            x = [table.column(f"x{i}").to_numpy() for i in range(len(booster.inputs))]
            y = table.column("y").to_numpy()
            parts = [table.column("id").to_numpy(), booster.binned(x), y]
            return pa.RecordBatch.from_arrays(
                [pa.array([len(y)]), *(pa.array([p.tobytes()], pa.binary()) for p in parts)],
                names=["n", "ids", "bins", "target"],
            )

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                count += batch.num_rows
            if count >= BLOCK:
                yield out()
                held, count = [], 0
        if held:
            yield out()

    return plain.mapInArrow(pack, "n bigint, ids binary, bins binary, target binary")


def blocks(stored: DataFrame, base: float) -> RDD[Block]:
    """Packed rows as arrays, each row predicted as ``base``."""

    def block(row: Row) -> Block:
        bins = np.frombuffer(row.bins, np.uint8).reshape(-1, row.n)
        return np.frombuffer(row.ids, np.int64), bins, np.frombuffer(row.target), np.full(row.n, base)

    return stored.rdd.map(block)


def drawn(ids: np.ndarray, tree: int, share: float, seed: int) -> np.ndarray:
    """Whether a tree sees each row: a mix of the row's hash and the tree's number."""
    with np.errstate(over="ignore"):
        x = ids.view(np.uint64) + np.uint64((seed * 1_000_003 + tree + 1) & (2**64 - 1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)) < np.uint64(share * (1 << 53))


def _added(a: Sums, b: Sums) -> Sums:
    """Both sums, slot by slot."""
    slots, place = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    gradient, hessian = np.zeros(len(slots), np.int64), np.zeros(len(slots), np.int64)
    for total, parts in ((gradient, (a[1], b[1])), (hessian, (a[2], b[2]))):
        np.add.at(total, place, np.concatenate(parts))
    return slots, gradient, hessian


def _keep_modules() -> None:
    """Leave a worker's modules out of its collections of garbage.

    A worker collects after every task, before it takes another one; looking through the loaded
    modules takes longer than a task that sums a few blocks.
    """
    if not gc.get_freeze_count():
        gc.freeze()


def histograms(
    state: RDD[Block], booster: Booster, tree: Tree, number: int, level: int, columns: np.ndarray,
    wanted: np.ndarray, scale: float, settings: Settings, tasks: int,
) -> tuple[np.ndarray, np.ndarray]:
    """(gradients, Hessians) by (node of the level, column, bin): one aggregate, one job.

    Only nodes ``wanted`` are summed. Sums of more than ``DIRECT`` tasks are added up in Spark
    before they come to the driver.
    """
    bins, nodes = settings.bins, 1 << level
    grid = len(columns) * bins

    def sums(parts: Iterable[Block]) -> Iterator[Sums]:
        _keep_modules()
        gradient = np.zeros((len(columns), nodes * bins), np.int64)
        hessian = np.zeros_like(gradient)
        for ids, binned, target, pred in parts:
            seen = np.flatnonzero(drawn(ids, number, settings.rows, settings.seed))
            node = tree.leaves(binned, level)[seen] - (nodes - 1)
            here = (node >= 0) & wanted[node]  # rows in a leaf of an earlier level take no part
            seen, first = seen[here], node[here] * bins
            # First and second derivative of half the squared error; the first in two parts
            # whose sums over a block are exact.
            g = np.rint((pred[seen] - target[seen]) * scale)
            high = np.floor(g * 2.0**-24)
            low = g - high * 2.0**24
            for i, column in enumerate(columns):
                slot, size = first + binned[column][seen], nodes * bins
                hessian[i] += np.bincount(slot, minlength=size)
                gradient[i] += np.bincount(slot, low, size).astype(np.int64)
                gradient[i] += np.bincount(slot, high, size).astype(np.int64) << 24
        gradient, hessian = (
            a.reshape(len(columns), nodes, bins).swapaxes(0, 1).reshape(-1) for a in (gradient, hessian)
        )
        used = np.flatnonzero(hessian)
        yield used, gradient[used], hessian[used]

    parts = state.mapPartitions(sums)
    # Arrays with a place per node, column and bin at most, from a few tasks.
    found = parts.collect() if tasks <= DIRECT else [parts.treeReduce(_added)]
    gradient, hessian = np.zeros(nodes * grid, np.int64), np.zeros(nodes * grid, np.int64)
    for slot, g, h in found:
        gradient[slot] += g
        hessian[slot] += h
    shape = (nodes, len(columns), bins)
    return gradient.reshape(shape), hessian.reshape(shape)


def smaller_children(tree: Tree, level: int, columns: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    """Which nodes of the next level to sum: of the children of a split, the one with fewer rows.

    ``hessian`` has the sums of this level, by node, column and bin.
    """
    wanted = np.zeros(2 << level, bool)
    for node in range(1 << level):
        here = (1 << level) - 1 + node
        if tree.feature[here] >= 0:
            counts = hessian[node, np.searchsorted(columns, tree.feature[here])]
            left = counts[: tree.cut[here] + 1].sum()
            wanted[2 * node + (left > counts.sum() - left)] = True
    return wanted


def with_siblings(
    wanted: np.ndarray, sums: tuple[np.ndarray, np.ndarray], parents: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Sums of all nodes of a level: a node that was not summed has its parent's less its sibling's."""
    summed = np.flatnonzero(wanted)
    for of_level, of_parents in zip(sums, parents):
        of_level[summed ^ 1] = of_parents[summed // 2] - of_level[summed]
    return sums


def split_level(
    tree: Tree, level: int, columns: np.ndarray, gradient: np.ndarray, hessian: np.ndarray,
    scale: float, settings: Settings, gains: np.ndarray,
) -> bool:
    """Split the nodes of a level where that gains; whether any was.

    Children get their leaf values at once. Of equal gains the first column and lowest bin win.
    """
    first = (1 << level) - 1
    split = False
    for node in range(1 << level):
        g, h = gradient[node].cumsum(axis=1) / scale, hessian[node].cumsum(axis=1).astype(float)
        total_g, total_h = g[0, -1], h[0, -1]
        if not total_h:
            continue
        left = np.minimum(h, total_h - h) >= settings.least_hessian
        score = (
            g**2 / (h + settings.l2)
            + (total_g - g) ** 2 / (total_h - h + settings.l2)
            - total_g**2 / (total_h + settings.l2)
        )
        score = np.where(left, score, -np.inf)
        best = int(score.argmax())
        i, cut = divmod(best, score.shape[1])
        if score[i, cut] <= 1e-12:
            continue
        here, split = first + node, True
        tree.feature[here], tree.cut[here] = columns[i], cut
        gains[columns[i]] += score[i, cut]
        for child, cg, ch in (
            (2 * here + 1, g[i, cut], h[i, cut]),
            (2 * here + 2, total_g - g[i, cut], total_h - h[i, cut]),
        ):
            tree.value[child] = -settings.rate * cg / (ch + settings.l2)
    return split


def grow(
    state: RDD[Block], booster: Booster, number: int, scale: float, settings: Settings, gains: np.ndarray,
    tasks: int, every: bool,
) -> Tree:
    """One tree, a job per level; ``every``: each node is summed, none taken from its parent."""
    size = (1 << (settings.depth + 1)) - 1
    tree = Tree(np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size))
    width = len(booster.inputs)
    rng = np.random.default_rng([settings.seed, number])
    columns = np.sort(rng.permutation(width)[: max(1, round(settings.columns * width))])
    jobs, wanted, parents = 0, np.ones(1, bool), None
    for level in range(settings.depth):
        sums = histograms(state, booster, tree, number, level, columns, wanted, scale, settings, tasks)
        jobs += 1
        if parents and not every:
            sums = with_siblings(wanted, sums, parents)
        if not split_level(tree, level, columns, *sums, scale, settings, gains):
            break
        parents = sums
        wanted = np.ones(2 << level, bool) if every else smaller_children(tree, level, columns, sums[1])
    booster.jobs.append(jobs)
    return tree


def advance(state: RDD[Block], booster: Booster, tree: Tree) -> RDD[Block]:
    """The blocks with the predictions of one more tree."""
    depth = booster.depth

    def step(block: Block) -> Block:
        ids, bins, target, before = block
        return ids, bins, target, before + tree.value[tree.leaves(bins, depth)]

    return state.map(step)


def _stored(spark: SparkSession, state: RDD[Block]) -> RDD[Block]:
    """The blocks written to the shared folder and read back."""
    path = fresh_path(spark, "blocks")
    state.saveAsPickleFile(path)
    return spark.sparkContext.pickleFile(path)


def fit_booster(
    rows: DataFrame,
    inputs: Sequence[str] = INPUTS,
    target: str = TARGET,
    keys: Sequence[str] = ("sku", "store_id", "ds"),
    settings: Settings = Settings(),
) -> Booster:
    """Fit on rows whose inputs and target are all known.

    ``keys`` name a row; trees draw rows by them, so the same rows and seed give the same trees
    however the rows are spread. The running predictions are kept with the blocks, in executor
    memory while a tree grows and in the shared folder every few trees; what a lost executor
    kept is computed again from there. An empty frame gives a booster without trees that
    predicts 0.
    """
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(target).cast("double")).alias("mean"),
        F.max(F.abs(F.col(target).cast("double"))).alias("most"),
        F.count_if(F.col(target).isNull() | F.isnan(F.col(target).cast("double"))).alias("unknown"),
    ).first()
    base = float(f"{facts['mean'] or 0.0:.9g}")  # a mean's last digits depend on the order of its sum
    booster = Booster(tuple(inputs), bin_edges(rows, inputs, settings), base, settings.depth)
    gains = np.zeros(len(inputs))
    booster.gains = gains
    if not facts["n"]:
        return booster
    # Whole numbers: the sum over all rows of four times the largest residual fits a long, and
    # a residual fits the 53 bits of a double.
    largest = 4 * max(facts["most"], 1.0)
    scale = 2.0 ** np.floor(np.log2(min(2.0**61 / (largest * facts["n"]), 2.0**52 / largest)))
    spark = rows.sparkSession
    state = blocks(stage(packed(rows, booster, target, keys), "blocks"), booster.base)
    state = state.persist(StorageLevel.MEMORY_AND_DISK)
    tasks = state.getNumPartitions()
    held: list[RDD[Block]] = [state]  # states in executor memory, the last one in use
    for number in range(settings.rounds):
        # An unknown target spoils the sums that it is in; a difference would spoil others by them.
        tree = grow(state, booster, number, scale, settings, gains, tasks, facts["unknown"] > 0)
        booster.trees.append(tree)
        while len(held) > 1:  # growing has filled the last one from the one before
            held.pop(0).unpersist()
        if tree.feature[0] < 0 and settings.rows >= 1 and settings.columns >= 1:
            break  # nothing gains any more
        if number == settings.rounds - 1:
            break
        after = advance(state, booster, tree)
        if (number + 1) % STORE_EVERY == 0:
            after = _stored(spark, after)
            tasks = after.getNumPartitions()
            while held:
                held.pop().unpersist()
        state = after.persist(StorageLevel.MEMORY_AND_DISK)
        held.append(state)
    while held:
        held.pop().unpersist()
    return booster


def predict(booster: Booster, rows: DataFrame, clip: bool = False) -> DataFrame:
    """Add ``predicted_demand`` to rows whose inputs are all known."""
    held = rows.sparkSession.sparkContext.broadcast(booster)  # trees of bounded size

    @F.pandas_udf("double")
    def predicted(columns: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = held.value
        for part in columns:
            bins = model.binned([c.to_numpy(float) for c in part])
            yield pd.Series(model.add_up(bins, np.full(bins.shape[1], model.base)))

    guess = predicted(*(F.col(c).cast("double") for c in booster.inputs))
    return rows.withColumn("predicted_demand", non_negative(guess) if clip else guess)


def score(booster: Booster, rows: DataFrame, name: str, clip: bool = False) -> DataFrame:
    """Predictions, errors and provenance beside the columns of ``rows``."""
    return predict(booster, rows, clip).select(
        "*", *error_columns(), F.lit(name).alias("model_used"), F.current_timestamp().alias("predicted_at")
    )
