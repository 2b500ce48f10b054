"""Small helpers that several operators share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are what stands between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before those that a column of ``docs`` has, whatever its case."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's rows per Arrow batch: documents are long, and a batch exists several times in memory."""
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


# Of a Python worker: how its caches are emptied, and the operator that its last task belonged to.
_emptied: list[Callable[[], None]] = []
_running = [""]


def kept(make: Callable) -> Callable:
    """``make`` with its results kept in a worker until its task ends, or one of another operator begins."""
    found = cache(make)
    _emptied.append(found.cache_clear)
    return found


def begin(operator: str) -> None:
    """Called where a task begins in a Python worker. What another operator has left there goes.

    Workers serve one stage after the other, so else the caches of all of them add up.
    """
    if _running[0] != operator:
        _running[0] = operator
        _empty()


def end() -> None:
    """Called where the task of an operator ends that keeps something.

    A worker waits for its next task with all it holds, and that task may be one that does not call :func:`begin`.
    """
    _running[0] = ""
    _empty()


def _empty() -> None:
    for empty in _emptied:
        empty()
    gc.collect()
    pa.default_memory_pool().release_unused()


BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


@contextmanager
def arrow_batches(spark: SparkSession, rows: int = 10_000) -> Iterator[None]:
    """Bound bytes and rows of the Arrow batches of what runs inside; the session's settings return afterwards."""
    wanted = {BYTES_SETTING: str(BATCH_BYTES), BATCH_SETTING: str(rows)}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
