"""Exact duplicates by a tree of merges over runs of text digests."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.rows import keyed, rows_in
from larder.session import stage

RUNS = 256
FAN_IN = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DIGEST = ("sha", "check", "bytes")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; NULL becomes the empty text.

    Texts of ASCII characters only, told by their length in bytes, take the quick function.
    """
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def digest_columns(text: Column) -> list[Column]:
    """SHA-256 with a second hash and the length, which verify it in every merge."""
    normal = lower_ascii(text)
    return [
        F.unhex(F.sha2(normal, 256)).alias("sha"),
        F.xxhash64(normal).alias("check"),
        F.octet_length(normal).alias("bytes"),
    ]


def merge_runs(
    digests: DataFrame,
    best: Callable[[str], Column] = F.max,
    runs: int = RUNS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per distinct text: (sha, check, bytes, keep, group_size).

    ``digests`` has the digest columns and ``rank``; the ``best`` rank is kept. Each input
    partition is a run. In every round ``fan_in`` neighbouring runs are merged into one:
    equal digests meet inside the merged run, the best rank and the number of rows stay,
    and the shorter run goes on. A merged run is spread over tasks by digest, and Spark
    combines before it shuffles, so a text that fills a third of the table sends one row
    per task and round. After log(runs) / log(fan_in) rounds one run is left.
    """
    level = digests.select(
        F.pmod(F.spark_partition_id(), F.lit(runs)).alias("run"),
        *DIGEST,
        F.col("rank").alias("keep"),
        F.lit(1).cast("bigint").alias("group_size"),
    )
    while runs > 1:
        runs = math.ceil(runs / fan_in)
        merged = F.floor(F.col("run") / fan_in).cast("int").alias("run")
        keys = ([merged] if runs > 1 else []) + [F.col(c) for c in DIGEST]
        level = level.groupBy(*keys).agg(
            best("keep").alias("keep"), F.sum("group_size").alias("group_size")
        )
    return level


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest"
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; NULL equals the empty text. Of
    equal texts the row with the largest (``keep="smallest"``: smallest) id stays. Rows
    repeated under one id count in ``group_size`` and share its ``kept``. A NULL id is kept
    only if no equal text has an id. An empty table gives no rows; other columns are not read.
    """
    digests = stage(
        docs.select(F.col(id_col).alias("id"), *digest_columns(F.col(text_col))), "digests"
    )
    # Stored, so that both sides of the join below are exchanged for it and adaptive
    # execution can split the copies of one text.
    best = F.max if keep == "largest" else F.min
    groups = stage(merge_runs(digests.withColumnRenamed("id", "rank"), best), "groups")
    return digests.join(groups, list(DIGEST)).select(
        F.col("id").alias(id_col),
        F.col("keep").alias("keep_id"),
        "group_size",
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay: exactly one per distinct text, all columns unchanged.

    The row with the largest id stays; rows repeated under that id are reduced to one.
    """
    table = keyed(docs)
    digests = stage(
        table.select(
            F.struct(F.col(f"row.{id_col}").alias("id"), "row_key").alias("rank"),
            *digest_columns(F.col(f"row.{text_col}")),
        ),
        "digests",
    )
    kept = merge_runs(digests).select("keep.row_key")
    return rows_in(table, kept)
