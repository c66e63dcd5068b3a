"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Recording the call site of every column expression slows plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(app: str = "larder", cores: int | str = 8, **extra: str) -> SparkSession:
    """A local session for tests, the benchmark and the command line.

    On a cluster the session comes from spark-submit; only sizes that make sense
    on one machine are set here.
    """
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": os.environ.get("LARDER_DRIVER_MEMORY", "16g"),
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    A private folder is made only in local mode with the setting absent. On a
    cluster that would hide files from the other machines, so it is an error.
    """
    context = spark.sparkContext
    configured = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_dir(spark)}/larder/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches of one query need the same expensive frame. A
    parquet table (rather than ``checkpoint()``) lets each branch prune columns,
    and a lost executor costs nothing that was already written.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, tasks: Sequence[Callable[[], Result]]) -> list[Result]:
    """The results of independent pieces of work, in order, each from a thread of its own.

    For work whose jobs are many and short or end in a few late tasks: Spark gives the cores
    that one piece leaves idle to the others. All pieces end before an error of one is raised.
    """
    with ThreadPoolExecutor(max(1, len(tasks))) as pool:
        return list(pool.map(lambda task: task(), [inheritable_thread_target(spark)(t) for t in tasks]))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the files that a query shuffled go as soon as it has ended.

    Otherwise they stay on the executors' disks until the driver happens to collect the frame
    as garbage, those of every table written so far. For pieces of work that run each frame once:
    a frame run again would shuffle again. Kept frames keep their files until they are dropped.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def clear_stages(spark: SparkSession) -> None:
    """Remove everything ``stage`` and ``fresh_path`` stored for queries of this session.

    A query returns a frame that still reads these files, so only the caller knows when
    they can go: call this after the result is collected or written. The benchmark, the
    query check and the pipeline's command line do. Frames that read the files become
    unusable.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/larder")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
