"""Isolation forest: bounded samples, trees grown in parallel, vectorised scoring."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions import flag
from larder.operators.anomalies import ISOLATION, KEYS, attach
from larder.operators.ranks import exact_quantiles

FEATURES = (
    "units_sold",
    "revenue",
    "demand",
    "units_sold_roll_mean_7",
    "units_sold_roll_std_7",
)
_NODES = (
    "tree int, sampled int, node int, feature int, threshold double, left int, right int,"
    " depth double"
)


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary tree over ``n`` values."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _grow(values: np.ndarray, limit: int, rng: np.random.Generator) -> list[tuple]:
    """Random splits down to single rows or the depth limit; node 0 is the root."""
    nodes: list[list] = []
    pending = [(np.arange(len(values)), 0, None, None)]
    while pending:
        rows, depth, parent, side = pending.pop()
        me = len(nodes)
        if parent is not None:
            nodes[parent][side] = me
        low, high = values[rows].min(axis=0), values[rows].max(axis=0)
        open_features = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(open_features) == 0:
            nodes.append([-1, 0.0, me, me, depth + average_path(len(rows))])
            continue
        feature = int(rng.choice(open_features))
        cut = float(rng.uniform(low[feature], high[feature]))
        # Between neighbouring floats the draw can round up to the top value.
        cut = cut if cut < high[feature] else float(low[feature])
        nodes.append([feature, cut, me, me, 0.0])
        below = values[rows, feature] <= cut
        pending.append((rows[~below], depth + 1, me, 3))
        pending.append((rows[below], depth + 1, me, 2))
    return [tuple(n) for n in nodes]


def _unit_hash(seed: int, *columns: Column | str) -> Column:
    """Pseudo-random number in [0, 1) that depends only on the row's own values."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 30)) / float(1 << 30)


def draw_samples(
    df: DataFrame, trees: int, sample_size: int, seed: int, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """About 3x ``sample_size`` rows per tree, cut to the ``sample_size`` smallest hashes.

    Sampling by key hash does not depend on partitioning, so a recomputed task draws
    the same rows. A first hash drops nearly all rows of a large table before any row
    is repeated for several trees.
    """
    count = df.agg(F.count(F.lit(1)).alias("_n"))
    share = F.least(F.lit(1.0), F.lit(3.0 * sample_size) / F.greatest(F.col("_n"), F.lit(1)))
    any_tree = F.least(F.lit(1.0), share * trees)
    chosen = (
        attach(df, count.select(share.alias("_share"), any_tree.alias("_any")))
        .where(_unit_hash(seed, *keys) < F.col("_any"))
        .withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        .withColumn("_u", _unit_hash(seed + 1, "tree", *keys))
        .where(F.col("_u") < F.col("_share") / F.col("_any"))
    )
    order = Window.partitionBy("tree").orderBy("_u", *keys)
    return (
        chosen.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= sample_size)
        .drop("_share", "_any", "_u", "_rank")
    )


@dataclass(frozen=True)
class IsolationForest:
    """A fitted forest: at most ``trees * 2 * sample_size`` nodes of parameters."""

    features: tuple[str, ...]
    depth_limit: int
    nodes: pd.DataFrame

    def score(self, df: DataFrame, column: str = "isolation_score") -> DataFrame:
        """Add the anomaly score: near 1 is isolated quickly, near 0.5 is ordinary."""
        trees = []
        for _, t in self.nodes.sort_values(["tree", "node"]).groupby("tree"):
            # Both children of a node side by side: [above the cut, at or below it].
            children = t[["right", "left"]].to_numpy(dtype=np.intp).ravel()
            feature = t["feature"].to_numpy(dtype=np.intp)
            trees.append((feature, t["threshold"].to_numpy(), children, t["depth"].to_numpy()))
        scale = average_path(self.nodes["sampled"].max()) or 1.0
        steps = self.depth_limit
        shared = df.sparkSession.sparkContext.broadcast(trees)

        @F.pandas_udf("double")
        def isolation(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=float, na_value=0.0) for c in columns])
            values, first = x.ravel(), np.arange(len(x)) * x.shape[1]
            depth = np.zeros(len(x))
            for feature, threshold, children, path in shared.value:
                at = np.zeros(len(x), dtype=np.intp)
                for _ in range(steps):
                    # A leaf is its own child, so rows that arrive early stay put.
                    below = values[first + feature[at]] <= threshold[at]
                    at = children[2 * at + below]
                depth += path[at]
            return pd.Series(np.exp2(-depth / (len(shared.value) * scale)))

        inputs = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.features]
        return df.withColumn(column, isolation(*inputs))


def fit_isolation_forest(
    df: DataFrame,
    features: tuple[str, ...] = FEATURES,
    trees: int = 100,
    sample_size: int = 256,
    seed: int = 42,
) -> IsolationForest:
    """Grow the trees on the executors, one bounded sample each.

    Only the finished trees come back, as model parameters do in any Spark ML fit.
    """
    limit = math.ceil(math.log2(max(sample_size, 2)))
    inputs = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]

    def grow(key: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        ordered = sample.sort_values(list(KEYS))
        rng = np.random.default_rng([seed, tree])
        nodes = _grow(ordered[list(features)].to_numpy(dtype=float), limit, rng)
        grown = pd.DataFrame(nodes, columns=["feature", "threshold", "left", "right", "depth"])
        grown.insert(0, "node", range(len(grown)))
        grown.insert(0, "sampled", len(sample))
        grown.insert(0, "tree", tree)
        return grown

    key_columns = [F.col(k) for k in KEYS if k not in features]
    samples = draw_samples(df.select(*key_columns, *inputs), trees, sample_size, seed)
    nodes = samples.groupBy("tree").applyInPandas(grow, _NODES).toPandas()
    return IsolationForest(features, limit, nodes)


def isolation_flags(scored: DataFrame, contamination: float = 0.05) -> DataFrame:
    """Flag the highest-scoring share of rows.

    Scores are compared at six decimals. The cut comes from distributed counts of the
    scores, so no task ranks them all.
    """
    score = F.round("isolation_score", 6)
    rounded = scored.select(score.alias("score"))
    cut = exact_quantiles(rounded, ["score"], {"cut": 1.0 - contamination})
    return attach(scored, cut).select(
        *scored.columns, flag(score > F.col("score_cut")).alias(ISOLATION)
    )
