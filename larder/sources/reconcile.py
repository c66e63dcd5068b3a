"""Row-level differences of two versions of a table, found through a tree of checksums.

A version is written in hash buckets of its key, with a checksum per bucket and, above the
buckets, checksums of groups of them up to one for the table. Two versions are compared from
the top: only groups that differ are looked into, and only buckets that differ are read.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 256
FAN = 16


class CheckedTable:
    """A version of a table in a folder: ``rows`` by bucket, ``sums`` by level and node."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = BUCKETS, fan: int = FAN):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.buckets, self.fan = buckets, fan

    @property
    def levels(self) -> int:
        """Levels above the buckets."""
        count, width = 0, self.buckets
        while width > 1:
            count, width = count + 1, -(-width // self.fan)
        return count

    def write(self, df: DataFrame) -> None:
        """Write the rows by bucket and their checksums; neither collects a row."""
        bucket = F.pmod(F.xxhash64(*marked(self.keys)), F.lit(self.buckets)).cast("int")
        rows = df.withColumn("_bucket", bucket)
        rows.hint("rebalance", "_bucket").write.mode("errorifexists").partitionBy("_bucket").parquet(f"{self.path}/rows")
        schema = self.spark.createDataFrame([(rows.schema.json(),)], "schema string")
        schema.coalesce(1).write.mode("errorifexists").text(f"{self.path}/schema")
        names = sorted(df.columns)
        # Read back, so that the sums are those of the stored rows.
        leaves = self.stored().groupBy(F.col("_bucket").cast("bigint").alias("node")).agg(
            F.count(F.lit(1)).alias("rows"), F.sum(row_hash(names)).alias("checksum")
        )
        nodes = leaves.select(F.lit(0).alias("level"), "*")
        tree = nodes
        for level in range(1, self.levels + 1):
            # A node's checksum depends on which of its children has which.
            nodes = nodes.groupBy(F.floor(F.col("node") / self.fan).alias("node")).agg(
                F.sum("rows").alias("rows"),
                F.sum(F.xxhash64("node", "rows", "checksum").cast("decimal(38,0)")).alias("checksum"),
            ).select(F.lit(level).alias("level"), "*")
            tree = tree.union(nodes)
        tree.write.mode("errorifexists").partitionBy("level").parquet(f"{self.path}/sums")

    def sums(self, level: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/sums").where(F.col("level") == level)

    def stored(self) -> DataFrame:
        """All rows with their bucket. No file is opened for the schema: it is kept apart."""
        schema = self.spark.read.text(f"{self.path}/schema").first()[0]
        return self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(f"{self.path}/rows")

    def rows(self, buckets: Sequence[int]) -> DataFrame:
        """The rows of some buckets; files of the others are not opened."""
        return self.stored().where(F.col("_bucket").isin(*buckets) if buckets else F.lit(False))


def marked(columns: Sequence[str]) -> list[Column]:
    """Columns with a mark each of whether it is NULL, which hashes pass over."""
    return [x for c in columns for x in (F.col(c).isNull(), F.col(c))]


def row_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*marked(columns)).cast("decimal(38,0)")


def differing_buckets(left: CheckedTable, right: CheckedTable) -> list[int]:
    """Numbers of the buckets that differ, at most ``buckets`` of them, by descent of the tree."""
    if (left.buckets, left.fan, left.keys) != (right.buckets, right.fan, right.keys):
        raise ValueError("the versions have different buckets or keys")
    wanted: list[int] | None = None
    for level in range(left.levels, -1, -1):
        a, b = (t.sums(level).select("node", "rows", "checksum") for t in (left, right))
        if wanted is not None:
            parents = F.floor(F.col("node") / left.fan)
            a, b = a.where(parents.isin(*wanted)), b.where(parents.isin(*wanted))
        b = b.toDF("node", "rows_b", "checksum_b")
        same = F.col("rows").eqNullSafe(F.col("rows_b")) & F.col("checksum").eqNullSafe(F.col("checksum_b"))
        wanted = sorted(r.node for r in a.join(b, "node", "full").where(~same).select("node").collect())
        if not wanted:
            return []
    return wanted


def row_differences(left: CheckedTable, right: CheckedTable) -> DataFrame:
    """(keys, change, columns): rows added, removed or changed from left to right.

    ``columns`` names the changed ones. Only buckets with different checksums are read. A key
    that stands for several rows has them paired in the order of their hashes. Columns that one
    side lacks count as NULL there.
    """
    buckets = differing_buckets(left, right)
    keys = left.keys
    a, b = left.rows(buckets).drop("_bucket"), right.rows(buckets).drop("_bucket")
    names = sorted(({*a.columns} | {*b.columns}) - {*keys})

    def side(df: DataFrame, mark: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(row_hash(sorted(df.columns)))
        other = [F.col(c) if c in df.columns else F.lit(None).alias(c) for c in names]
        numbered = df.select(*keys, *other, F.row_number().over(order).alias("_copy"))
        packed = F.struct(*(F.col(c) for c in names)) if names else F.struct(F.lit(0).alias("_none"))
        return numbered.select(*(F.col(k).alias(f"{mark}{k}") for k in keys), F.col("_copy").alias(f"{mark}_copy"), packed.alias(f"{mark}row"))

    one, two = side(a, "l_"), side(b, "r_")
    match = [F.col(f"l_{k}").eqNullSafe(F.col(f"r_{k}")) for k in keys]
    joined = one.join(two, [*match, F.col("l__copy") == F.col("r__copy")], "full")
    gone, new = F.col("r_row").isNull(), F.col("l_row").isNull()
    changed = F.array_compact(
        F.array(
            *(
                F.when(~F.col("l_row")[c].eqNullSafe(F.col("r_row")[c]), F.lit(c))
                for c in names
            )
        ).cast("array<string>")
    )
    change = F.when(new, "added").when(gone, "removed").otherwise("changed")
    found = joined.select(
        *(F.coalesce(f"l_{k}", f"r_{k}").alias(k) for k in keys),
        change.alias("change"),
        F.when(new | gone, F.array().cast("array<string>")).otherwise(changed).alias("columns"),
    )
    return found.where((F.col("change") != "changed") | (F.size("columns") > 0))


def difference_counts(differences: DataFrame) -> DataFrame:
    """(change, column, rows): a row per kind of change, and per column for changed rows."""
    columns = F.when(F.col("change") == "changed", F.col("columns")).otherwise(F.array(F.lit("*")))
    return (
        differences.select("change", F.explode(columns).alias("column"))
        .groupBy("change", "column")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
