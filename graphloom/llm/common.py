"""Helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.sources.checkpoints import shared_dir

#: A word is a run of characters other than blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
NOT_WORD = r"[\x20\x09-\x0D]+"

#: Rows up to which a side is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000
#: Rows and bytes of a batch that goes to a Python task, and files of different folders that a task writes at once, so
#: that it needn't sort its rows by folder.
LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "2m", "spark.sql.maxConcurrentOutputFileWriters": "8"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/graphloom-{uuid.uuid4().hex}/{name}"


@contextmanager
def little_memory(spark: SparkSession) -> Iterator[None]:
    """Within it, what runs keeps to LIMITS, whatever the session's own."""
    before = {k: spark.conf.get(k) for k in LIMITS}
    for k, v in LIMITS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def freed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which the memory that its task no longer uses goes back to the system: a worker outlives many tasks,
    and the allocators would keep the most that any of them took."""

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return whole


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """df written as Parquet to the shared folder and read back: lineage ends there and survives lost executors."""
    at = fresh_dir(df.sparkSession, name)
    with little_memory(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df with a broadcast hint if it has few rows by count; else as it is, and the join shuffles."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
