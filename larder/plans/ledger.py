"""A table of pipeline runs, by which a failed run resumes and an unchanged stage is skipped."""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from larder.sources.layers import path_exists

SCHEMA = (
    "run string, step bigint, stage string, state string, inputs map<string, string>,"
    " outputs map<string, string>, started timestamp, ended timestamp, error string"
)
DONE, FAILED, SKIPPED = "done", "failed", "skipped"


@dataclass(frozen=True)
class Stage:
    """A stage of a pipeline: what it runs, and the folders it reads and writes."""

    name: str
    work: Callable[[], object]
    inputs: Sequence[str]
    outputs: Sequence[str]


def folder_mark(spark: SparkSession, path: str) -> str:
    """A digest of the files below a folder: names, lengths, times. No file is opened."""
    if not path_exists(spark, path):
        return "absent"
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, files = [], system.listFiles(root, True)
    while files.hasNext():
        file = files.next()
        found.append(f"{file.getPath()} {file.getLen()} {file.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


class Ledger:
    """The run table, in a folder: one small file per finished stage, never rewritten."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def table(self) -> DataFrame:
        """Every recorded stage of every run."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def record(self, *row) -> None:
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def last_done(self, stage: str):
        """The latest record of a stage that ended well, or None."""
        done = self.table().where(f"state = '{DONE}'").where(self._is(stage))
        return done.orderBy("ended", ascending=False).first()

    @staticmethod
    def _is(stage: str):
        from pyspark.sql import functions as F

        return F.col("stage") == stage

    def marks(self, paths: Sequence[str]) -> Mapping[str, str]:
        return {p: folder_mark(self.spark, p) for p in paths}

    def run(self, stages: Sequence[Stage], run: str | None = None) -> dict[str, str]:
        """Run stages in order and record each; {stage: state}.

        A stage is skipped if it ended well before, on the inputs that are there now, and its
        outputs are still what it left. So a run that failed goes on at the stage that failed
        when it is started again, and a change of an input runs all that depends on it. A
        failure is recorded and raised.
        """
        run = run or uuid.uuid4().hex
        states: dict[str, str] = {}
        for step, stage in enumerate(stages, 1):
            started = dt.datetime.now()
            inputs = self.marks(stage.inputs)
            before = self.last_done(stage.name)
            if before and dict(before.inputs) == inputs and dict(before.outputs) == self.marks(stage.outputs):
                states[stage.name] = SKIPPED
                self.record(run, step, stage.name, SKIPPED, inputs, dict(before.outputs), started, dt.datetime.now(), None)
                continue
            try:
                stage.work()
            except Exception as error:
                self.record(run, step, stage.name, FAILED, inputs, {}, started, dt.datetime.now(), str(error)[:2000])
                raise
            states[stage.name] = DONE
            self.record(run, step, stage.name, DONE, inputs, self.marks(stage.outputs), started, dt.datetime.now(), None)
        return states
