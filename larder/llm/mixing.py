"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.rows import keyed
from larder.session import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3


@dataclass(frozen=True)
class Settings:
    """``block_words``: words of a source that move together; ``shard_words``: words of an
    output shard."""

    seed: str = "mix-1"
    block_words: int = 1 << 13
    shard_words: int = 1 << 20


def word_count(text: Column) -> Column:
    """Number of words; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Number, weight and target of each source from (source, source_size).

    Sources take the weights 1, 2, 3, 1, ... in code-point order, NULL last, and share the
    words of all sources by weight. No target exceeds three times its source; what is cut
    off is shared by weight among the others, until none is above. In closed form: in
    ascending order of size per weight a source is cut off if its share of what the ones
    before it leave is above its limit, and the first that is not sets the share of the rest.
    The windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sizes.withColumn("source_no", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("source_no") % len(WEIGHTS) + 1)
    limit = F.col("source_size") * MAX_REPEATS
    steps = Window.orderBy(
        F.col("limit").cast("double") / F.col("weight"), F.col("source_no")
    )
    before = steps.rowsBetween(Window.unboundedPreceding, -1)
    onward = steps.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    share = (
        F.sum("source_size").over(everything)
        - F.coalesce(F.sum("limit").over(before), F.lit(0))
    ).cast("double") / F.sum("weight").over(onward)
    stepped = (
        numbered.withColumns({"weight": weight, "limit": limit})
        .withColumns({"share": share, "step": F.row_number().over(steps)})
        .withColumn("cut", F.col("weight") * F.col("share") > F.col("limit"))
    )
    open_share = F.min_by("share", F.when(~F.col("cut"), F.col("step"))).over(everything)
    return stepped.withColumn("open_share", open_share).select(
        "source_no",
        "source",
        "source_size",
        "weight",
        F.when(F.col("cut"), F.col("limit").cast("double"))
        .otherwise(F.col("weight") * F.col("open_share"))
        .alias("target"),
    )


# -- the splitting tree ---------------------------------------------------------

# One draw: how many of the marked blocks of a pool fall into a room for some of them, from
# a uniform u, by inversion. Weights run by their exact ratios from the mode to 12 standard
# deviations either side, beyond which nothing is left in double precision.
_DRAW = """
element_at(transform(array(struct({pool} AS pool, {marked} AS marked, {room} AS room)), d ->
element_at(transform(array(struct(
    greatest(0L, d.room - (d.pool - d.marked)) AS lo, least(d.room, d.marked) AS hi,
    cast(ceil(12 * sqrt(cast(d.room AS double) * d.marked * (d.pool - d.marked) * (d.pool - d.room)
        / (cast(d.pool AS double) * d.pool * greatest(d.pool - 1, 1L)))) AS bigint) + 12 AS reach,
    cast(floor((d.room + 1D) * (d.marked + 1D) / (d.pool + 2D)) AS bigint) AS peak)), m0 ->
element_at(transform(array(struct(
    least(m0.hi, greatest(m0.lo, m0.peak)) AS mode,
    greatest(m0.lo, least(m0.hi, greatest(m0.lo, m0.peak)) - m0.reach) AS a,
    least(m0.hi, least(m0.hi, greatest(m0.lo, m0.peak)) + m0.reach) AS b)), m ->
element_at(transform(array(struct(
    aggregate(slice(sequence(m.mode, m.b), 1, cast(m.b - m.mode AS int)),
        named_struct('w', 1D, 's', 1D), (x, k) -> named_struct(
        'w', x.w * ((d.marked - k) * cast(d.room - k AS double) / ((k + 1) * cast(d.pool - d.marked - d.room + k + 1 AS double))),
        's', x.s + x.w * ((d.marked - k) * cast(d.room - k AS double) / ((k + 1) * cast(d.pool - d.marked - d.room + k + 1 AS double))))) AS up,
    aggregate(slice(sequence(m.mode, m.a), 1, cast(m.mode - m.a AS int)),
        named_struct('w', 1D, 's', 0D), (x, k) -> named_struct(
        'w', x.w * (k * cast(d.pool - d.marked - d.room + k AS double) / ((d.marked - k + 1) * cast(d.room - k + 1 AS double))),
        's', x.s + x.w * (k * cast(d.pool - d.marked - d.room + k AS double) / ((d.marked - k + 1) * cast(d.room - k + 1 AS double))))) AS down)), t ->
aggregate(sequence(m.a, m.b),
    named_struct('w', t.down.w, 'c', 0D, 'k', m.b),
    (x, k) -> named_struct(
        'w', x.w * ((d.marked - k) * cast(d.room - k AS double) / ((k + 1) * cast(d.pool - d.marked - d.room + k + 1 AS double))),
        'c', x.c + x.w,
        'k', if(x.c < {u} * (t.up.s + t.down.s) AND x.c + x.w >= {u} * (t.up.s + t.down.s), k, x.k)),
    x -> x.k)
), 1)), 1)), 1)), 1)
"""

# The left child's quota of every source, drawn one source after the other from what is
# left: a multivariate-hypergeometric sample of the node's blocks.
_LEFT = """
aggregate(sequence(0, size(quotas) - 1),
    named_struct('all', total, 'room', left_total, 'out', cast(array() AS array<bigint>)),
    (acc, s) -> element_at(transform(array({draw}), x -> named_struct(
        'all', acc.all - quotas[s],
        'room', acc.room - x,
        'out', concat(acc.out, array(x)))), 1),
    acc -> acc.out)
"""


def _uniform(seed: str) -> str:
    return f"((pmod(xxhash64('{seed}', first, shards, s), 1L << 52) + 0.5D) / cast(1L << 52 AS double))"


def split_quotas(quotas: DataFrame, shards: int, seed: str) -> DataFrame:
    """(shard, source_no, quota): exact block quotas of the sources, split among shards.

    ``quotas`` has one row (source_no, quota) per source. The root of a binary tree holds
    them all; a node over several shards gives its left half a number of blocks in
    proportion and draws, without replacement, how many of each source they are; the
    right half gets the rest. So quotas add up exactly at every node, and a shard's
    composition is distributed as if all blocks had been shuffled. The nodes of a level are
    rows: no level depends on more than its own row, and draws hang on the seed alone.
    """
    nodes = quotas.agg(
        F.array_sort(F.collect_list(F.struct("source_no", "quota"))).alias("all")
    ).select(
        F.lit(0).cast("bigint").alias("first"),
        F.lit(shards).cast("bigint").alias("shards"),
        F.transform("all", lambda x: x["source_no"]).alias("sources"),
        F.transform("all", lambda x: x["quota"]).alias("quotas"),
    )
    # The expression is evaluated for inner nodes only; a source without blocks draws none.
    draw = _DRAW.format(
        pool="acc.all", marked="quotas[s]", room="acc.room", u=_uniform(seed)
    )
    draw = f"if(quotas[s] = 0 OR acc.room = 0, 0L, {draw})"
    for level in range(max(0, math.ceil(math.log2(shards)))):
        if level == 6:  # enough rows to spread
            nodes = nodes.repartition("first")
        inner = F.col("shards") > 1
        sized = nodes.withColumn(
            "total", F.expr("aggregate(quotas, 0L, (a, x) -> a + x)")
        ).withColumns(
            {
                "left_shards": F.expr("shards div 2"),
                "left_total": F.expr("total * (shards div 2) div greatest(shards, 1L)"),
            }
        )
        drawn = sized.withColumn(
            "left", F.when(inner, F.expr(_LEFT.format(draw=draw))).otherwise(F.col("quotas"))
        )
        left = F.struct(
            F.col("first").alias("first"),
            F.when(inner, F.col("left_shards")).otherwise(F.col("shards")).alias("shards"),
            F.col("left").alias("quotas"),
        )
        right = F.struct(
            (F.col("first") + F.col("left_shards")).alias("first"),
            (F.col("shards") - F.col("left_shards")).alias("shards"),
            F.zip_with("quotas", "left", lambda a, b: a - b).alias("quotas"),
        )
        children = F.when(inner, F.array(left, right)).otherwise(F.array(left))
        nodes = drawn.select("sources", F.explode(children).alias("c")).select(
            "c.first", "c.shards", "sources", "c.quotas"
        )
    cells = F.arrays_zip(F.col("sources").alias("source_no"), F.col("quotas").alias("quota"))
    return nodes.select(F.col("first").alias("shard"), F.explode(cells).alias("c")).select(
        "shard", F.col("c.source_no").alias("source_no"), F.col("c.quota").alias("quota")
    )


def block_shards(cells: DataFrame) -> DataFrame:
    """(source_no, block, shard): each shard draws the next blocks of every source."""
    earlier = (
        Window.partitionBy("source_no")
        .orderBy("shard")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.coalesce(F.sum("quota").over(earlier), F.lit(0))
    return (
        cells.withColumn("start", start)
        .where(F.col("quota") > 0)
        .select(
            "source_no",
            F.explode(F.sequence("start", F.col("start") + F.col("quota") - 1)).alias("block"),
            "shard",
        )
    )


# -- the mix ---------------------------------------------------------------------


def plan_mix(table: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The draws of a mix: one row per row of ``table`` and repeat, or one with no shard.

    ``table`` has row_key (unique), id, source and size. Every source is put in a random
    order given by a hash of the ids and cut there into blocks of ``block_words``; read in
    a circle, up to three times, its first words up to the target are the mix. A document
    belongs to the block in which it begins, and is in if its middle is, so the words taken
    miss the target by half a document at most. Blocks are dealt to the shards by the
    splitting tree.

    Result: row_key, id, size, source_size, target, repeat, shard (NULL: not drawn).
    """
    order = F.md5(F.concat(F.lit(settings.seed), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    table = stage(
        table.select("row_key", "id", "source", "size", order.alias("place")), "mix-rows"
    )
    sizes = table.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stage(source_targets(sizes), "mix-targets")
    rows, words = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    # About as many buckets as documents in a bucket: two levels of even windows.
    digits = math.ceil(math.log(max(1, rows), 16) / 2)
    shards = max(1, math.ceil(words / settings.shard_words))

    numbered = table.withColumn("bucket", F.substring("place", 1, digits)).join(
        targets.withColumnRenamed("source", "its_source"),
        F.col("source").eqNullSafe(F.col("its_source")),
    )
    # Where a bucket begins in its source: a window over bucket sums, not over documents.
    cell = ["source_no", "bucket"]
    earlier = (
        Window.partitionBy("source_no")
        .orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        numbered.groupBy(*cell)
        .agg(F.sum("size").alias("words"))
        .select(*cell, F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"))
    )
    inside = (
        Window.partitionBy(*cell)
        .orderBy("place", "id", "size", "row_key")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = numbered.join(starts, cell).withColumn(
        "before", F.col("start") + F.sum("size").over(inside) - F.col("size")
    )
    begin = F.col("repeat") * F.col("source_size") + F.col("before")
    copies = (
        placed.withColumn("repeat", F.explode(F.array(*map(F.lit, range(MAX_REPEATS)))))
        .withColumn("in", (begin * 2 + F.col("size") <= F.col("target") * 2) & (F.col("size") > 0))
        .where(F.col("in") | (F.col("repeat") == 0))
        .withColumn("block", F.when(F.col("in"), F.floor(begin / settings.block_words)))
    )
    quotas = targets.select(
        "source_no", F.ceil(F.col("target") / settings.block_words).alias("quota")
    )
    dealt = block_shards(split_quotas(quotas, shards, settings.seed))
    return copies.join(dealt, ["source_no", "block"], "left").select(
        "row_key", "id", "size", "source_size", "target", "repeat", "shard"
    )


def mixed_sizes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    settings: Settings = Settings(),
) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken (words, repeats counted).

    NULL and empty texts have size 0 and are never taken; a NULL source is a source of its
    own, the last. Rows repeated under one id are rows of their own. An empty table gives
    no rows. Reruns agree: the order hangs on ids and the seed alone.
    """
    table = keyed(docs.select(id_col, text_col, source_col)).select(
        "row_key",
        F.col(f"row.{id_col}").alias("id"),
        F.col(f"row.{source_col}").alias("source"),
        word_count(F.col(f"row.{text_col}")).alias("size"),
    )
    taken = F.sum(F.when(F.col("shard").isNotNull(), F.col("size")).otherwise(0))
    return (
        plan_mix(table, settings)
        .groupBy("row_key", "id", "size", "source_size", "target")
        .agg(taken.alias("taken"))
        .select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    settings: Settings = Settings(),
) -> DataFrame:
    """The mix itself: rows of ``docs``, repeated as drawn, dealt to shards and shuffled there.

    Same rules as ``mixed_sizes``. Each shard lies in one partition, in random order.
    """
    table = keyed(docs)
    sized = table.select(
        "row_key",
        F.col(f"row.{id_col}").alias("id"),
        F.col(f"row.{source_col}").alias("source"),
        word_count(F.col(f"row.{text_col}")).alias("size"),
    )
    draws = (
        plan_mix(sized, settings)
        .where(F.col("shard").isNotNull())
        .select("row_key", "shard", "repeat")
    )
    place = F.xxhash64(F.lit(settings.seed), "shard", "row_key", "repeat")
    return (
        table.join(draws, "row_key")
        .withColumn("place", place)
        .repartition("shard")
        .sortWithinPartitions("shard", "place")
        .select("row.*")
    )
