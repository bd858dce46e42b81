"""Reading the corpus tables and putting their columns into a defined form."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; every other character stays as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def held_out_remainder(column: str = "doc_id") -> Column:
    """crc32 of the id's decimal text modulo 5; rows with remainder 0 are held out of training."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5


def row_key() -> list[Column]:
    """id and mark: never-null keys of a row by its id and text; only rows that repeat both (or a clash of 64-bit
    hashes under one id) share them."""
    return [
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"),
        F.xxhash64(whole_text(), F.col("doc_id").isNull()).alias("mark"),
    ]


def give_back_memory() -> None:
    """For the end of a task: unused memory goes back to the system, as workers live on beside those of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of most clusters has it
    if trim:
        trim(0)
