"""Small helpers around DataFrames: written tables, bounded groups, Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import roadloom
from roadloom.sources.scratch import materialize, new_folder

__all__ = ["batch_bytes", "grouped", "materialize", "new_folder", "read", "small_batches", "tidy"]


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table, after making sure the workers have this package."""
    roadloom.ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hand Python 2,000 rows at a time instead of 10,000, unless the session has its own setting: rows here are whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "2000")


@contextlib.contextmanager
def batch_bytes(spark: SparkSession, limit: str = "4m"):
    """Within this context tables are handed to Python in batches of at most about ``limit``; the session's own setting is restored."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, limit)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def tidy(run):
    """``run`` over Arrow batches, giving freed memory back at the end of the task; workers are used again and would keep it."""

    def tidied(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library: nothing to trim
            pass

    return tidied


def grouped(batches, keys: list[str]):
    """Successive tables of rows with equal ``keys`` from batches sorted by them. Callers see to it that groups are bounded."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        begin = 0
        for i in range(1, len(values) + 1):
            if i < len(values) and values[i] == values[begin]:
                continue
            if last is not None and values[begin] != last and held:
                yield last, pa.concat_tables(held)
                held = []
            last = values[begin]
            held.append(pa.Table.from_batches([batch.slice(begin, i - begin)]))
            begin = i
    if held:
        yield last, pa.concat_tables(held)
