"""Keys without a parent, by a Bloom filter that a distributed aggregate builds."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.session import stage

# A block of the filter has this many words of 64 bits; a key sets one bit in each.
WORDS = 8
KEYS_PER_BLOCK = 48  # 512 bits: about ten a key, one false answer in some hundred
MOST_BYTES = 256 << 20


def _word(i: int) -> str:
    return f"w{i}"


def _bits(key: Column) -> list[Column]:
    """One bit of each word, from a hash apart from that of the block."""
    marks = [F.xxhash64(key, F.lit(1)), F.xxhash64(key, F.lit(3))]
    one = F.lit(1).cast("bigint")
    return [
        F.call_function("shiftleft", one, F.pmod(F.shiftright(marks[i % 2], 6 * (i // 2)), F.lit(64)).cast("int"))
        for i in range(WORDS)
    ]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(2)), F.lit(blocks))


def bloom_filter(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """(block, w0 ... w7): the filter of all keys, a row per block that holds any.

    Tasks combine their keys into blocks before anything is shuffled.
    """
    key = F.col(column)
    marked = keys.where(key.isNotNull()).select(
        _block(key, blocks).alias("block"), *(b.alias(_word(i)) for i, b in enumerate(_bits(key)))
    )
    return marked.groupBy("block").agg(*(F.bit_or(_word(i)).alias(_word(i)) for i in range(WORDS)))


def blocks_for(keys: int) -> int:
    """Blocks of a filter for so many keys."""
    return max(1, math.ceil(keys / KEYS_PER_BLOCK))


def filter_bytes(blocks: int) -> int:
    return blocks * 8 * (WORDS + 1)


def anti_join(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    most_bytes: int = MOST_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """((key, rows) of child keys without a parent, one row of counts).

    The filter over the parent's keys is broadcast if its size, known from their number, is at
    most ``most_bytes``. A key whose bits are not all set has no parent and needs no join; only
    the others are shuffled and compared with the parent's keys. Beyond that size every key is
    compared. The counts: keys, ruled_out, compared, orphans, by_filter. NULL keys are no
    orphans; an empty parent leaves every key an orphan.
    """
    key = F.col(column)
    keys = (
        child.where(key.isNotNull()).groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    )
    known = parent.select(F.col(parent_column).cast(keys.schema["key"].dataType).alias("key"))
    distinct = known.agg(F.approx_count_distinct("key")).first()[0]
    blocks = blocks_for(distinct)
    if filter_bytes(blocks) > most_bytes:
        found = stage(keys.join(known, "key", "left_anti"), "orphans")
        none = F.lit(0).cast("bigint")
        facts = keys.agg(F.count(F.lit(1)).alias("keys")).crossJoin(  # one row each
            found.agg(F.count(F.lit(1)).alias("orphans"))
        )
        return found, facts.select(
            "keys", none.alias("ruled_out"), F.col("keys").alias("compared"), "orphans", F.lit(False).alias("by_filter")
        )
    words = F.broadcast(stage(bloom_filter(known, "key", blocks), "filter"))  # size checked above
    probed = keys.withColumn("block", _block(F.col("key"), blocks)).join(words, "block", "left")
    set_ = [F.col(_word(i)).bitwiseAND(b) != 0 for i, b in enumerate(_bits(F.col("key")))]
    maybe = F.coalesce(F.forall(F.array(*set_), lambda x: x), F.lit(False))
    probed = stage(probed.select("key", "rows", maybe.alias("maybe")), "probed")
    compared = probed.where("maybe").select("key", "rows").join(known, "key", "left_anti")
    found = stage(probed.where("NOT maybe").select("key", "rows").union(compared), "orphans")
    facts = probed.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(~F.col("maybe")).alias("ruled_out"),
        F.count_if("maybe").alias("compared"),
    ).crossJoin(found.agg(F.count(F.lit(1)).alias("orphans")))  # one row each
    return found, facts.withColumn("by_filter", F.lit(True))
