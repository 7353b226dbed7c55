"""What several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of all contracts: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
NOT_SPACE = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_text(name: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def as_rows(df: DataFrame) -> DataFrame:
    """All columns as the one struct ``row``."""
    return df.select(F.struct("*").alias("row"))


BATCH_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "4m"


@contextmanager
def small_batches(spark: SparkSession, size: str = BATCH_BYTES) -> Iterator[None]:
    """In this block, jobs hand rows to Python in batches of about ``size`` at most.

    Rows alone bound a batch otherwise, so that one of long texts is in memory as a whole,
    in the JVM and in Python. The rows are the same.
    """
    before = spark.conf.get(BATCH_BYTES_CONF)
    spark.conf.set(BATCH_BYTES_CONF, size)
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES_CONF, before)


_Batches = Iterator[pa.RecordBatch]


def release_memory() -> None:
    """Give back what this Python worker no longer uses: it lives on, over other stages too."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def releasing(run: Callable[[_Batches], _Batches]) -> Callable[[_Batches], _Batches]:
    """A function for ``mapInArrow`` after which a task's memory is given back."""

    def released(batches: _Batches) -> _Batches:
        yield from run(batches)
        release_memory()

    return released
