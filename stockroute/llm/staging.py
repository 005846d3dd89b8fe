"""Written intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData, SparkSession

from stockroute.session import ensure_checkpoint_dir

#: Spark drops the shuffle files of a finished write when this is on, so the
#: disk need of an operator is that of its largest phase, not of their sum.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of whole texts are long: smaller batches bound the memory of both sides.
_BATCH, _BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "2000"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Plans that run inside send texts to Python in small batches."""
    before = spark.conf.get(_BATCH, "10000")
    spark.conf.set(_BATCH, _BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def give_back() -> None:
    """Return the freed memory of this process to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass


def map_batches(df: DataFrame, each: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema) -> DataFrame:
    """``mapInArrow`` whose tasks leave no freed memory behind.

    Python workers outlive their tasks and keep what these freed, so that without it all
    workers of a long job stay as large as the largest task that they ever ran.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from each(batches)
        finally:
            give_back()
    return df.mapInArrow(run, schema)


def map_groups(groups: GroupedData, each: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
               schema) -> DataFrame:
    """``applyInArrow`` over the batches of a group, which leaves no freed memory behind either."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from each(batches)
        finally:
            give_back()
    return groups.applyInArrow(run, schema)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder below ``spark.checkpoint.dir`` and read it back.

    The lineage is cut at storage that every executor shares: a lost executor
    costs only its running tasks.  ``release`` removes the table once nothing
    reads it any more.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        with small_batches(spark):
            df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Remove written tables of ``stage``.  Only for tables whose last reader has been
    written itself: whatever is computed from them later would not find them."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that further ones can't clash with an operator's own."""
    return df.select(*[df[n] for n in names])
