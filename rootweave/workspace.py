"""Where intermediate results are written.

Iterative work has to cut its lineage. Every cut here is a Parquet directory below
the folder named by ``spark.checkpoint.dir``: it survives the loss of executors, can
be read by all of them, and gives later joins true file sizes to plan with.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"
PARTITIONS_SETTING = "spark.sql.shuffle.partitions"
# Rows that one task should get after a shuffle; edges and labels take some 50 bytes each.
ROWS_PER_TASK = 2_000_000
# Rows that a task gets where it keeps several copies of them in memory, as it does to sort or to make distinct.
ROWS_PER_DEAL = 250_000


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the session; a local one only for a local master."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    return _local_root(context.applicationId)


@cache
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="run-")


class Workspace:
    """A private folder for the staged frames and scratch tables of one run.

    A workspace with a ``name`` outlives a run that fails, so that the next run of that name can go on from what was
    finished, see :class:`rootweave.operators.components.Rounds`; it goes when a run ends well.
    """

    def __init__(self, spark: SparkSession, name: str | None = None):
        self.spark = spark
        attempt = uuid.uuid4().hex
        self.name = name
        self.base = f"{checkpoint_root(spark)}/rootweave-{name or attempt}"
        self.path = f"{self.base}/{attempt}" if name else self.base
        self._steps = 0
        self._partitions: str | None = None
        self._make()

    def expect(self, rows: int) -> None:
        """Make shuffles wide enough for ``rows`` rows while the workspace is open.

        The setting is only ever raised; adaptive execution merges what turns out small.
        """
        current = self.spark.conf.get(PARTITIONS_SETTING)
        wanted = rows // ROWS_PER_TASK
        if wanted > int(current):
            self._partitions = self._partitions or current
            self.spark.conf.set(PARTITIONS_SETTING, str(wanted))

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` and return a frame that reads what was written."""
        return self.stage_counted(df, label)[0]

    def stage_counted(self, df: DataFrame, label: str, **metrics: Column) -> tuple[DataFrame, dict]:
        """Like :meth:`stage`, and count the rows (and other aggregates) while writing."""
        path = self.new_path(label)
        counted, seen = count_while_writing(df, **metrics)
        counted.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), seen.get

    def new_path(self, label: str) -> str:
        """Where the next frame is staged."""
        path = f"{self.path}/{self._steps:04d}-{label}"
        self._steps += 1
        return path

    def scratch_database(self) -> str:
        """Create an empty database whose tables live inside this workspace."""
        name = f"scratch_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE DATABASE {name} LOCATION '{self.path}/{name}'")
        return name

    def release(self) -> None:
        """Let Spark delete the shuffle files of frames that nothing refers to any more.

        It does so when the driver collects its garbage, which a driver with little to do may not do for long.
        """
        gc.collect()
        self.spark._jvm.System.gc()

    def close(self) -> None:
        """Delete the workspace; frames read from it are invalid afterwards."""
        self._restore_width()
        path, fs = self._hadoop_path(self.base)
        fs.delete(path, True)

    def _restore_width(self) -> None:
        if self._partitions:
            self.spark.conf.set(PARTITIONS_SETTING, self._partitions)
            self._partitions = None

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, error, *_) -> None:
        if error and self.name:
            self._restore_width()
        else:
            self.close()

    def _hadoop_path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _make(self) -> None:
        path, fs = self._hadoop_path(self.path)
        fs.mkdirs(path)
        if not self.name:
            fs.deleteOnExit(path)


def deal(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """``df`` dealt by ``columns``; the tasks are as many as its ``rows`` need, and adaptive execution does not merge them.

    So what one task holds does not grow with the input. Few rows are dealt as the session's settings say.
    """
    tasks = rows // ROWS_PER_DEAL
    return df.repartition(tasks, *columns) if tasks >= 8 else df.repartition(*columns)


def count_while_writing(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of its ``rows`` and of other aggregates, filled by the next write."""
    seen = Observation()
    named = [F.count(F.lit(1)).alias("rows")] + [c.alias(n) for n, c in metrics.items()]
    return df.observe(seen, *named), seen
