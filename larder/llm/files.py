"""Files that tasks write to, and read from, the shared folder."""

from __future__ import annotations

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession


def attempt_name(stem: str) -> str:
    """A file name of this task attempt: an attempt that fails leaves no valid file."""
    context = TaskContext.get()
    return f"{stem}-{context.partitionId():06d}-{context.taskAttemptId()}"


def open_folder(uri: str):
    """(file system, path) of a folder in any store that pyarrow reaches."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    return system, path


def spread(df: DataFrame, spark: SparkSession) -> DataFrame:
    """A short table of work units, dealt out evenly.

    An explicit number of partitions: adaptive execution would put the few bytes of such a
    table into one task, though each row stands for a file or a block.
    """
    return df.repartition(max(1, df.count()))
