"""Reading and writing the layered tables: raw, bronze, silver, gold."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.schemas import DATE_COLUMNS, RAW_TABLES, conform
from larder.session import side_by_side

FORMAT = "parquet"
# Smaller files than the default codec's at about the same speed.
COMPRESSION = "zstd"
# What the rows of a file are ordered by: first their day, which the columns taken from it follow.
# A file then holds long runs of equal values, in the tables that are read from it in its order too.
FILE_ORDER = {
    "sales": ("date", "sku"),
    "inventory": ("snapshot_date", "sku"),
    "purchase_orders": ("order_date", "po_id"),
    "shipments": ("planned_ship_date", "sku"),
    "supplier_product_map": ("sku", "supplier_id"),
    "demand_forecasts": ("forecast_date", "sku"),
    "production_orders": ("planned_date", "sku"),
}


def scan(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet scan of one file or of a whole folder of files."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def parse_dates(df: DataFrame, columns: Iterable[str], pattern: str | None = None) -> DataFrame:
    """Turn date columns into timestamps; unreadable values become NULL, absent columns are
    passed over."""
    layout = [F.lit(pattern)] if pattern else []
    return df.withColumns(
        {
            c: F.try_to_timestamp(F.col(c).cast("string"), *layout)
            for c in columns
            if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)
        }
    )


def with_ingest_metadata(df: DataFrame) -> DataFrame:
    """Add the load time and the file each row came from."""
    return df.select(
        "*",
        F.current_timestamp().alias("_loaded_at"),
        F.col("_metadata.file_path").alias("_source_file"),
    )


def in_file_order(df: DataFrame, table: str) -> DataFrame:
    """The rows of each task in the table's file order; no row changes its task."""
    order = [c for c in FILE_ORDER.get(table, ()) if c in df.columns]
    return df.sortWithinPartitions(*order) if order else df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Metadata lookup on whatever file system the path names."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


class Layer:
    """A folder of tables that share a refinement level."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = FORMAT):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        return path_exists(self.spark, self.path(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.format(self.fmt).load(self.path(table))

    def write(
        self, table: str, df: DataFrame, partition_by: tuple[str, ...] = (), options=None
    ) -> int:
        """Overwrite a table, schema included, and return the rows written.

        The count comes from an observation on the write itself, so nothing is
        computed twice.
        """
        seen = Observation()
        writer = (
            df.observe(seen, F.count(F.lit(1)).alias("rows"))
            .write.format(self.fmt)
            .mode("overwrite")
            .options(**{"compression": COMPRESSION, **(options or {})})
        )
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(self.path(table))
        return seen.get["rows"]

    def write_by_date(self, table: str, df: DataFrame, day: Column) -> int:
        """Overwrite, laid out by year and month for partition pruning.

        The rebalance hint lets AQE size the writers: few files per month, yet a
        month holding a large share of the rows is split over many tasks.
        """
        dated = df.withColumns({"_year": F.year(day), "_month": F.month(day)}).hint(
            "rebalance", "_year", "_month"
        )
        return self.write(table, dated, partition_by=("_year", "_month"))


class VersionedLayer(Layer):
    """A layer whose tables are replaced by switching a small pointer file.

    A write goes to a folder of its own; only when it is complete does the pointer name it, by
    one rename that replaces the old pointer. Until then, and if the write fails, readers see
    the table as it was. The pointer keeps the schema of every version. On object stores
    without an atomic rename the switch is as safe as their rename is.
    """

    POINTER = "_current"

    def _file_system(self, path: str):
        jvm = self.spark.sparkContext._jvm
        jvm_path = jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return jvm, jvm_path, jvm_path.getFileSystem(conf), conf

    def _pointer(self, table: str) -> dict | None:
        jvm, path, system, _ = self._file_system(f"{self.root}/{table}/{self.POINTER}")
        if not system.exists(path):
            return None
        stream = system.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _switch(self, table: str, pointer: dict) -> None:
        folder = f"{self.root}/{table}"
        jvm, new, system, conf = self._file_system(f"{folder}/{self.POINTER}.{uuid.uuid4().hex}")
        stream = system.create(new, False)
        try:
            stream.write(bytearray(json.dumps(pointer).encode()))
        finally:
            stream.close()
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), conf)
        context.rename(new, jvm.org.apache.hadoop.fs.Path(f"{folder}/{self.POINTER}"), options)

    def exists(self, table: str) -> bool:
        return self._pointer(table) is not None

    def version(self, table: str) -> str:
        pointer = self._pointer(table)
        if pointer is None:
            raise FileNotFoundError(f"{self.root}/{table} has no version")
        return pointer["history"][-1]["version"]

    def path(self, table: str) -> str:
        return f"{self.root}/{table}/{self.version(table)}"

    def history(self, table: str) -> DataFrame:
        """(number, version, row_count, schema) of every version, the first one first."""
        found = (self._pointer(table) or {"history": []})["history"]
        rows = [(i, v["version"], v["rows"], json.dumps(v["schema"])) for i, v in enumerate(found, 1)]
        return self.spark.createDataFrame(rows, "number int, version string, row_count bigint, schema string")

    def read_version(self, table: str, version: str) -> DataFrame:
        return self.spark.read.format(self.fmt).load(f"{self.root}/{table}/{version}")

    def write(
        self, table: str, df: DataFrame, partition_by: tuple[str, ...] = (), options=None
    ) -> int:
        """Write a new version and switch to it; returns the rows written."""
        before = self._pointer(table) or {"history": []}
        version = f"v-{uuid.uuid4().hex}"
        rows = Layer(self.spark, f"{self.root}/{table}", self.fmt).write(version, df, partition_by, options)
        entry = {"version": version, "rows": rows, "schema": df.schema.jsonValue()}
        self._switch(table, {"history": [*before["history"], entry]})
        return rows


def ingest(
    raw: Layer,
    bronze: Layer,
    tables: Iterable[str] = tuple(RAW_TABLES),
    suffix: str = ".parquet",
) -> dict[str, int | None]:
    """Load every raw table that is present, side by side; absent ones are reported as None."""

    def load(table: str) -> int | None:
        name = table + suffix if raw.exists(table + suffix) else table
        if not raw.exists(name):
            return None
        df = parse_dates(with_ingest_metadata(raw.read(name)), DATE_COLUMNS.get(table, ()))
        if table in RAW_TABLES:
            df = conform(df, table, strict=False)
        return bronze.write(table, in_file_order(df, table))

    names = list(tables)
    return dict(zip(names, side_by_side(raw.spark, [partial(load, t) for t in names])))


def row_counts(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """(table, row_count, status) for each table; an absent one is a row, not an error."""
    if not tables:
        raise ValueError("no tables given")
    spark = next(df.sparkSession for df in tables.values() if df is not None)

    def one(name: str, df: DataFrame | None) -> DataFrame:
        counted = spark.range(1) if df is None else df.agg(F.count(F.lit(1)).alias("n"))
        count = F.lit(0).cast("bigint") if df is None else F.col("n")
        return counted.select(
            F.lit(name).alias("table"),
            count.alias("row_count"),
            F.lit("missing" if df is None else "ok").alias("status"),
        )

    return reduce(DataFrame.unionByName, (one(n, df) for n, df in tables.items()))


def create_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Replace a catalog table with the result of a query."""
    df.write.mode("overwrite").format(FORMAT).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: count and an order-free content checksum.

    One map-side aggregation and no shuffle of rows, so two versions of a table of
    any size can be compared. The hash passes over NULLs, so each value goes in with a mark
    of whether it is one: a NULL that changes its column changes the checksum.
    """
    names = columns or sorted(df.columns)
    marked = [x for c in names for x in (F.col(c).isNull(), F.col(c))]
    digest = F.xxhash64(*marked).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(digest).alias("checksum"))


def reconcile(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Compare two implementations table by table: counts and content."""

    def one(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
        a = fingerprint(left).toDF("left_rows", "left_sum")
        b = fingerprint(right).toDF("right_rows", "right_sum")
        return a.crossJoin(F.broadcast(b)).select(
            F.lit(name).alias("table"),
            "left_rows",
            "right_rows",
            (F.col("left_rows") == F.col("right_rows")).alias("counts_match"),
            F.col("left_sum").eqNullSafe(F.col("right_sum")).alias("content_match"),
        )

    return reduce(DataFrame.unionByName, (one(n, a, b) for n, (a, b) in pairs.items()))


def sample_rows(df: DataFrame, order_by: list[str], n: int = 3) -> DataFrame:
    """The first rows in a stated order, so the sample is reproducible."""
    return df.orderBy(*order_by).limit(n)
