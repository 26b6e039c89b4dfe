"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words and white space as every operator here reads them.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text; none for a null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Of rows that go to a Python worker at a time; they are held on both sides.
BATCH_BYTES = "8m"


def small_batches(spark: SparkSession) -> None:
    """Bounds what goes to a Python worker at a time by bytes, for rows that hold whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def give_back() -> None:
    """Hands a worker's free memory back to the system: the worker outlives its task, beside the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def drop_shuffles(spark: SparkSession) -> None:
    """Has the driver collect its garbage, so that the files of shuffles that nothing reads any more go now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
