"""Shared pieces: tables, lineage cuts in the cluster's shared folder, connected components, vector checks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.lineage import cut
from strandloom.operators.graph import components

__all__ = ["batches", "components", "cut", "finite_vector", "numbered", "table", "whole"]

#: Rows of an Arrow batch of texts: some megabytes, on both sides of the pipe.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of ``sf_dir``, read by Spark only (the path may lie in any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Returns a worker's freed memory to the machine: workers are kept and would hold the most they ever used."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library, which needs no asking or has no such call
        pass


def batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow over batches of at most BATCH_ROWS rows; the worker's memory goes back after each task.

    The batch size is a setting of the session, read when the plan runs; it is lowered, never raised.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(it)
        give_back()

    return df.mapInArrow(task, schema)


def numbered(df: DataFrame, key: Column, order: list[Column], name: str, rows: int = 100_000) -> DataFrame:
    """Adds ``name``, a number of its own from 0 on, to every row, in the order of a hash of ``key`` and then of ``order``.

    Rows are numbered within ranges of the hash, of about ``rows`` rows each; counts of the ranges before give the first.
    """
    hashed = df.withColumn("__h", F.xxhash64(key))
    bits = max(4, (df.count() // rows).bit_length())
    hashed = hashed.withColumn("__b", F.shiftrightunsigned("__h", 64 - bits))
    counts = cut(hashed.groupBy("__b").count(), "range-counts")  # one row a range
    before = counts.select(F.col("__b").alias("__b2"), (F.sum("count").over(Window.orderBy("__b")) - F.col("count")).alias("__first"))
    number = F.row_number().over(Window.partitionBy("__b").orderBy("__h", *order)) - 1 + F.col("__first")
    return hashed.join(before, F.col("__b") == F.col("__b2")).withColumn(name, number.cast("bigint")).drop("__h", "__b", "__b2", "__first")


def whole(df: DataFrame) -> Column:
    """All columns of a row as one struct, so that an operator's own columns can't clash with them."""
    return F.struct(*(F.col(f"`{c}`").alias(c) for c in df.columns)).alias("row")


def finite_vector(col: Column) -> Column:
    """True for a vector that is not null, not empty, not all zeros and has only finite components."""
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(col.isNotNull() & (F.size(col) > 0) & ~bad & F.exists(col, lambda x: x != 0), F.lit(False))
