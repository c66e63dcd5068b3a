"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is named by (owner, depth): the smallest conversation that starts with it, and its
number of turns. The conversations a node belongs to are rows of the path table, so nothing
about a node is ever held whole by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.buckets import map_cells
from larder.operators.ranks import running_totals
from larder.session import stage

BLOCK = 4096
FAMILY = 5
HEADS = 9
NODE = ["owner", "depth"]


def family_base(conv: Column) -> Column:
    return conv - conv % FAMILY


def head_turns(conv: Column) -> Column:
    """How many turns a conversation takes over from the first of its family."""
    return F.crc32(conv.cast("string")) % HEADS


def ordered_turns(
    conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str
) -> DataFrame:
    """(conv, pos, digest, bytes, n_turns): turns in order, texts replaced by their digest.

    Equal turns of one number are counted before they are ranked, and ranks come from sums
    over even slices, so neither a long conversation nor a repeated row meets one task.
    """
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv"),
        F.col(turn_col).alias("turn"),
        digest.alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    counted = turns.groupBy("conv", "turn", "digest").agg(
        F.min("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")
    )
    ranked = running_totals(counted, ["turn", "digest"], {"n": "n"}, within=["conv"])
    places = F.sequence(F.col("n_through") - F.col("n"), F.col("n_through") - 1)
    return ranked.select(
        "conv", F.explode(places).alias("pos"), "digest", "bytes", F.col("n_total").alias("n_turns")
    )


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations after their heads are exchanged: (conv, length), and their turns.

    A conversation starts with the first turns of its family's first one, as many as
    ``head_turns`` says or there are, and goes on with its own turns after as many of them.
    """
    conv = F.col("conv")
    known = turns.groupBy("conv").agg(F.max("n_turns").alias("n_turns"))
    lengths = known.select(conv.alias("base"), F.col("n_turns").alias("base_turns"))
    taken = head_turns(conv)
    plan = stage(
        known.withColumns({"base": family_base(conv), "skip": taken})
        .join(lengths, "base", "left")
        .withColumn("head", F.least("skip", F.coalesce("base_turns", F.lit(0))))
        .withColumn("length", F.col("head") + F.greatest(F.col("n_turns") - F.col("skip"), F.lit(0)))
        .select("conv", "base", "skip", "head", "length"),
        "conversations",
    )
    first = turns.where(F.col("pos") < HEADS - 1).select(F.col("conv").alias("base"), "pos", "digest", "bytes")
    heads = plan.join(first, "base").where(F.col("pos") < F.col("head"))
    tails = turns.join(plan.select("conv", "skip", "head"), "conv").where(F.col("pos") >= F.col("skip"))
    moved = (F.col("head") + F.col("pos") - F.col("skip")).alias("pos")
    rows = heads.select("conv", "pos", "digest", "bytes").union(
        tails.select("conv", moved, "digest", "bytes")
    )
    return plan.select("conv", "length"), rows


def prefix_rows(rebuilt: DataFrame) -> DataFrame:
    """(conv, depth, bytes, key, parent): every prefix of every conversation by a key.

    The key of a prefix adds up hashes of its (place, turn) pairs, 180 bits in three sums, so
    that keys of all prefixes are running totals and a prefix's parent has its key less one
    addend.
    """
    marked = rebuilt.withColumn("mark", F.sha2(F.concat_ws(":", "pos", "digest"), 256))
    pieces = [
        F.conv(F.substring("mark", 15 * i + 1, 15), 16, 10).cast("decimal(20,0)").alias(f"p{i}")
        for i in range(3)
    ]
    summed = running_totals(
        marked.select("conv", "pos", "bytes", *pieces),
        ["pos"],
        {f"s{i}": f"p{i}" for i in range(3)},
        within=["conv"],
    )
    sums = [F.col(f"s{i}_through") for i in range(3)]
    before = [F.col(f"s{i}_through") - F.col(f"p{i}") for i in range(3)]
    return summed.select(
        "conv",
        (F.col("pos") + 1).alias("depth"),
        "bytes",
        F.concat_ws(".", F.col("pos") + 1, *sums).alias("key"),
        F.concat_ws(".", "pos", *before).alias("parent"),
    )


def build(lengths: DataFrame, rebuilt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie: nodes, and the path table (conv, depth, owner, parent_owner).

    Nodes have owner, depth, parent_owner, n_convs, n_children, bytes and size, the number of
    nodes in the subtree. The nodes a conversation owns are the end of its path, so a subtree
    has, for each of its conversations, the owned nodes from its top on: one aggregate.
    """
    rows = stage(prefix_rows(rebuilt), "prefixes")
    grouped = rows.groupBy("key").agg(
        F.min("conv").alias("owner"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("bytes").alias("bytes"),
        F.min("depth").alias("depth"),
        F.min("parent").alias("parent"),
    )
    named = stage(grouped, "named")
    children = named.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    root = lengths.agg(
        F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n_convs")
    ).where(F.col("owner").isNotNull())
    steps = stage(
        rows.select("conv", "depth", "key").join(named.select("key", "owner"), "key").drop("key"), "steps"
    )
    above = steps.select("conv", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent_owner"))
    starts = steps.where("depth = 1").select("conv", F.lit(1).cast("bigint").alias("depth"))
    starts = starts.crossJoin(F.broadcast(root.select(F.col("owner").alias("parent_owner"))))  # one row
    path = stage(steps.join(above.union(starts), ["conv", "depth"]), "path")

    owned = (
        path.where(F.col("owner") == F.col("conv"))
        .groupBy("conv")
        .agg(F.count(F.lit(1)).alias("n_owned"), F.max("depth").alias("length"))
    )
    from_top = F.col("length") - F.greatest(F.col("length") - F.col("n_owned"), F.col("depth") - 1)
    sizes = (
        path.join(owned, "conv")
        .where(from_top > 0)
        .groupBy(*NODE)
        .agg(F.sum(from_top).alias("size"), F.max(F.when(F.col("conv") == F.col("owner"), F.col("parent_owner"))).alias("parent_owner"))
    )
    deep = (
        named.join(children, "key", "left")
        .join(sizes, NODE)
        .select(*NODE, "parent_owner", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "bytes", "size")
    )
    counts = named.agg(
        F.count(F.lit(1)).alias("nodes"), F.count_if(F.col("depth") == 1).alias("n_children")
    )
    zero = F.lit(0).cast("bigint")
    shallow = root.crossJoin(F.broadcast(counts)).select(  # one row beside one row
        "owner", zero.alias("depth"), F.lit(None).cast("bigint").alias("parent_owner"), "n_convs",
        "n_children", zero.alias("bytes"), (F.col("nodes") + 1).alias("size"),
    )
    return deep.union(shallow), path


VALUES = ("n_leaves", "saved_tokens")


def split_large(forest: DataFrame, path: DataFrame, block: int) -> DataFrame:
    """Take centroids out of components until none has more than ``block`` nodes.

    One round treats all large components: the centroid is the deepest node with at least half
    of its component below it. Its subtree's total is added to every node from it up to the
    component's top, its children's subtrees become components of their own, and what stays
    above is half of the component at most. A component that holds nearly all nodes costs as
    many rounds as its size can be halved.
    """
    comp = ["top_owner", "top_depth"]
    is_top = (F.col("owner") == F.col("top_owner")) & (F.col("depth") == F.col("top_depth"))
    while True:
        large = forest.where(~F.col("done") & is_top & (F.col("size") > block)).select(
            *comp, F.col("size").alias("total")
        )
        if large.isEmpty():
            return forest
        centroids = stage(
            forest.where(~F.col("done"))
            .join(large, comp)
            .where(F.col("size") * 2 >= F.col("total"))
            .groupBy(*comp)
            .agg(F.max(F.struct("depth", "owner", "size")).alias("c"))
            .select(*comp, F.col("c.owner").alias("c_owner"), F.col("c.depth").alias("c_depth"), F.col("c.size").alias("c_size")),
            "centroids",
        )
        # Conversations that go on below a centroid, and the child they go through.
        through = path.select("conv", F.col("owner").alias("child"), "parent_owner", (F.col("depth") - 1).alias("d"))
        below = through.join(
            centroids.select(*comp, "c_owner", "c_depth"),
            (F.col("parent_owner") == F.col("c_owner")) & (F.col("d") == F.col("c_depth")),
        ).select(*comp, F.col("conv").alias("owner"), "child", F.col("c_depth").alias("cut"))
        marked = stage(
            forest.join(below, [*comp, "owner"], "left")
            .withColumn("moves", ~F.col("done") & F.coalesce(F.col("depth") > F.col("cut"), F.lit(False)))
            .select(*forest.columns, "child", "cut", "moves"),
            "marked",
        )
        center = centroids.select(*comp, F.col("c_owner").alias("owner"), F.col("c_depth").alias("depth"), F.lit(True).alias("center"))
        inside = marked.join(center, [*comp, *NODE], "left").where(F.col("moves") | F.col("center"))
        totals = inside.groupBy(*comp).agg(*(F.sum(f"{v}_own").alias(f"{v}_add") for v in VALUES))
        # From the centroid to the top of its component, along the centroid's own conversation.
        upwards = centroids.join(totals, comp).withColumnRenamed("c_owner", "conv")
        added = (
            path.select("conv", *NODE)
            .union(_root_steps(forest, centroids))
            .join(upwards, "conv")
            .where(F.col("depth").between(F.col("top_depth"), F.col("c_depth")))
            .select(
                *NODE,
                *(f"{v}_add" for v in VALUES),
                (F.col("depth") == F.col("c_depth")).alias("centre"),
                "c_size",
            )
        )
        zero = F.lit(0).cast("bigint")
        forest = stage(
            marked.join(added, NODE, "left").select(
                *NODE,
                "parent_owner",
                F.when(F.col("moves"), F.col("child")).otherwise(F.col("top_owner")).alias("top_owner"),
                F.when(F.col("moves"), F.col("cut") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
                (F.col("size") - F.when(F.col("centre"), zero).otherwise(F.coalesce("c_size", zero))).alias("size"),
                (F.col("done") | F.coalesce("centre", F.lit(False))).alias("done"),
                *(f"{v}_own" for v in VALUES),
                *((F.col(v) + F.coalesce(f"{v}_add", zero)).alias(v) for v in VALUES),
            ),
            "forest",
        )


def _root_steps(forest: DataFrame, centroids: DataFrame) -> DataFrame:
    """(conv, owner, depth) of the root, for the conversations of centroids."""
    root = forest.where("depth = 0").select(*NODE)  # one row
    return centroids.select(F.col("c_owner").alias("conv")).distinct().crossJoin(F.broadcast(root))


def roll_up(parent: np.ndarray, depth: np.ndarray, size: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Subtree sums of ``own`` (rows: nodes) over a forest, by centroid decomposition.

    ``parent`` has the row of each node's parent or -1, ``size`` the nodes of its subtree. All
    components take a step at a time: every one loses its centroid, whose subtree's total goes
    to the nodes from it to the top.
    """
    here = np.arange(len(parent))
    size, sums = size.copy(), np.zeros_like(own)
    comp = _tops(np.where(parent < 0, here, parent))
    active = np.ones(len(parent), bool)
    while active.any():
        nodes = np.flatnonzero(active)
        heavy = nodes[2 * size[nodes] >= size[comp[nodes]]]
        heavy = heavy[np.lexsort((depth[heavy], comp[heavy]))]
        last = np.ones(len(heavy), bool)
        last[:-1] = comp[heavy[1:]] != comp[heavy[:-1]]
        centre = heavy[last]
        is_centre = np.zeros(len(parent), bool)
        is_centre[centre] = True
        # Cut above and below each centroid, and between components.
        above = np.where(parent < 0, here, parent)
        cut = (above == here) | (comp[above] != comp) | is_centre | is_centre[above]
        tops = _tops(np.where(cut, here, above))
        over = above[tops]
        inside = active & (is_centre | (is_centre[over] & (comp[over] == comp)))
        target = np.where(is_centre, here, over)[inside]
        total = np.zeros_like(own)
        np.add.at(total, target, own[inside])
        step, carried, lost = centre, total[centre], size[centre]
        first = True
        while len(step):
            sums[step] += carried
            if not first:
                size[step] -= lost
            up = parent[step]
            goes = (up >= 0) & (comp[up] == comp[step])
            step, carried, lost, first = up[goes], carried[goes], lost[goes], False
        active[centre] = False
        comp = np.where(active | is_centre, tops, comp)
    return sums


def _tops(up: np.ndarray) -> np.ndarray:
    """The end of every chain of links, by doubling."""
    while True:
        further = up[up]
        if np.array_equal(further, up):
            return up
        up = further


def finish_small(forest: DataFrame) -> DataFrame:
    """(owner, depth, *VALUES) of the components that fit one task, many of them at a time."""

    def work(cells: np.ndarray, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        owner, depth, above, size = (
            rows.column(c).to_numpy(zero_copy_only=False) for c in ("owner", "depth", "above", "size")
        )
        names, code = np.unique(owner, return_inverse=True)
        span = int(depth.max()) + 2
        key = code * span + depth
        order = np.argsort(key)
        at = np.minimum(np.searchsorted(names, above), len(names) - 1)
        wanted = at * span + depth - 1
        found = order[np.minimum(np.searchsorted(key, wanted, sorter=order), len(key) - 1)]
        known = (names[at] == above) & (key[found] == wanted) & (cells[found] == cells)
        parent = np.where(known & (depth > 0), found, -1)
        own = np.stack([rows.column(f"{v}_own").to_numpy() for v in VALUES], axis=1)
        so_far = np.stack([rows.column(v).to_numpy() for v in VALUES], axis=1)
        sums = so_far + roll_up(parent, depth, size, own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(owner), pa.array(depth), *(pa.array(sums[:, i].copy()) for i in range(len(VALUES)))],
            names=[*NODE, *VALUES],
        )

    members = forest.where(~F.col("done")).select(
        F.struct("top_owner", "top_depth").alias("cell"),
        *NODE,
        F.coalesce("parent_owner", "owner").alias("above"),
        "size",
        *(f"{v}_own" for v in VALUES),
        *VALUES,
    )
    columns = [c for c in members.columns if c != "cell"]
    schema = ", ".join(f"{c} bigint" for c in (*NODE, *VALUES))
    return map_cells(members, columns, work, schema)


def subtree_sums(nodes: DataFrame, path: DataFrame, block: int = BLOCK) -> DataFrame:
    """(owner, depth, n_leaves, saved_tokens) over each node's subtree."""
    root = nodes.where("depth = 0").select(F.col("owner").alias("top_owner"))
    zero = F.lit(0).cast("bigint")
    forest = stage(
        nodes.crossJoin(F.broadcast(root)).select(  # one row
            *NODE,
            "parent_owner",
            "top_owner",
            zero.alias("top_depth"),
            "size",
            F.lit(False).alias("done"),
            (F.col("n_children") == 0).cast("bigint").alias("n_leaves_own"),
            ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens_own"),
            *(zero.alias(v) for v in VALUES),
        ),
        "forest",
    )
    forest = split_large(forest, path, block)
    return finish_small(forest).union(forest.where("done").select(*NODE, *VALUES))


def end_digests(ends: DataFrame, block: int = BLOCK) -> DataFrame:
    """(owner, depth, ends_sha256) of the conversations that end at each node.

    Ids are joined in groups of ``block``. A node with more has its groups hashed one after
    the other, as they come sorted from Spark: a task then reads a row per group and keeps none.
    """
    sizes = ends.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    large = stage(sizes.where(F.col("n") > block).select(*NODE), "many-ends")
    few = ends.join(sizes.where(F.col("n") <= block).select(*NODE), NODE, "left_semi")
    short = few.groupBy(*NODE).agg(F.sha2(text, 256).alias("ends_sha256"))
    if large.isEmpty():
        return short
    crowd = ends.join(large, NODE, "left_semi").withColumn("one", F.lit(1))
    ranked = running_totals(crowd, ["conv"], {"n": "one"}, within=NODE)
    groups = ranked.groupBy(*NODE, F.floor((F.col("n_through") - 1) / block).alias("part")).agg(text.alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None

        def out():
            values = [[held[0]], [held[1]], [state.hexdigest()]]
            return pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=[*NODE, "ends_sha256"])

        for batch in batches:
            for owner, depth, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if held == (owner, depth):
                    state.update(b",")
                else:
                    if held:
                        yield out()
                    held, state = (owner, depth), hashlib.sha256()
                state.update(ids.encode())
        if held:
            yield out()

    long = (
        groups.repartition(*NODE)
        .sortWithinPartitions(*NODE, "part")
        .select(*NODE, "ids")
        .mapInArrow(hashed, "owner bigint, depth bigint, ends_sha256 string")
    )
    return short.union(long)


def conversation_trie(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """One row per distinct beginning of the rebuilt conversations.

    Turns are ordered by number, NULL first; turns of one number by the digest of role and
    text, rows repeated in full being turns of their own. A NULL role or text is empty. Rows
    without a conversation id take no part. Ids may be negative: the family of -3 is that of 0.
    Other columns are not read; an empty table gives no rows, not even a root.

    ``n_leaves`` and ``saved_tokens`` are summed over subtrees by centroid decomposition of the
    parent-edge forest: in Spark while a component has more than ``block`` nodes, in tasks
    after that.
    """
    turns = stage(ordered_turns(conversations, id_col, turn_col, role_col, text_col), "turns")
    lengths, rebuilt = rebuild(turns)
    nodes, path = build(lengths, rebuilt)
    nodes = stage(nodes, "nodes")
    sums = subtree_sums(nodes, path, block)
    root = nodes.where("depth = 0").select(*NODE)  # one row
    ends = lengths.withColumnRenamed("length", "depth").join(
        path.select("conv", *NODE), ["conv", "depth"]
    ).select(*NODE, "conv")
    turnless = lengths.where("length = 0").select("conv").crossJoin(F.broadcast(root))
    ends = stage(ends.union(turnless.select(*NODE, "conv")), "ends")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        nodes.join(sums, NODE)
        .join(end_digests(ends, block), NODE, "left")
        .select(
            F.col("owner").alias("conv_id"),
            "depth",
            F.col("parent_owner").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", empty).alias("ends_sha256"),
        )
    )
