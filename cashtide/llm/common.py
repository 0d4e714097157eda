"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows handed to Python at once. Texts may be long, so batches are small; the bytes of a batch are bounded too.
BATCH_ROWS = "512"
BATCH_BYTES = str(16 << 20)

#: White space between words, as a character class of both Java and RE2.
WORD = r"[^\x20\x09-\x0D]+"


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str | Column) -> Column:
    """The text as UTF-8 bytes, null as none."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit("")).cast("binary")


def fold(column: str | Column, buckets: int) -> Column:
    """crc32 of the value as text, modulo ``buckets``. A null value falls into fold 0 of its own crc, that of an empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % F.lit(buckets)


def binary_values(column: pa.Array) -> list[bytes]:
    return column.to_pylist()


def record_batches(columns: dict[str, object], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One batch of the given columns, or none if they are empty."""
    arrays = [pa.array(columns[f.name], type=f.type) for f in schema]
    if len(arrays[0]):
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` for each start, as many as its length."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))
