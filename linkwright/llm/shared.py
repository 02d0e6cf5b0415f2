"""Shared storage and small plan helpers of the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: the session's spark.checkpoint.dir, or a local one where that is
    unset and the master is local."""
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not where:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
        where = "file:///tmp/checkpoints"
        sc.setCheckpointDir(where)
    return where.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as Parquet to the shared folder and read it again. A lost executor loses nothing of it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.materialized_at = path
    return out


def forget(df: DataFrame) -> None:
    """Delete the files of a table from materialize() that no later plan reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.materialized_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def by_bytes(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose values of a column have about `most` bytes, one row at least: what bounds a task's memory."""
    block = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)) // most
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    yield from (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False) if b > a)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, giving freed memory back to the system when a task ends: Python workers live on, and the next stage's tasks
    (or the executor's JVM) need what the allocators would keep."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only glibc has it
                ctypes.CDLL(None).malloc_trim(0)

    return inner
