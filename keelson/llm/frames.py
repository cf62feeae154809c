"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import scratch_path

#: Up to so many counted narrow rows are broadcast.
BROADCAST_ROWS = 1_000_000


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def named(**columns: str) -> list[Column]:
    """Columns under the names an operator works with; others stay behind.

    An input may hold further columns, also with names an operator uses inside.
    """
    return [F.col(f"`{source}`").alias(name) for name, source in columns.items()]


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bounds what a Python worker holds at a time: texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def give_back() -> None:
    """Returns free memory of this process to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``; a Python worker waits for further tasks, and does not keep what the last one needed."""
    def call(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return call


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, to be broadcast if it is counted to be small, else to be joined by shuffle."""
    return F.broadcast(df) if df.count() <= rows else df.hint("merge")


def bucketed(df: DataFrame, column: str, label: str) -> DataFrame:
    """``df``, stored in buckets of ``column``: joins on it move the other side only."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    df.write.bucketBy(shuffle_width(spark), column).sortBy(column).saveAsTable(
        name, path=scratch_path(spark, label))
    return spark.table(name)
