"""What several operators share: split rules, written intermediate tables, slices of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.storage import scratch_path

SLICE_BYTES = 1 << 18
ROWS_AT_ONCE = 256


def remainder(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % n


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the input folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialize(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: a cut of lineage that
    outlives executors."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def binary_values(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a string column, a few rows at a time; a null is the empty text."""
    for at in range(0, len(column), ROWS_AT_ONCE):
        for value in column.slice(at, ROWS_AT_ONCE).cast(pa.binary()).to_pylist():
            yield value or b""


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, pa.Array]]:
    """(start, end, part) of runs of a string column of about ``limit`` bytes together; a longer text is a
    run of its own. Only the run at hand is turned into Python objects."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield start, i, column.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes), column.slice(start)


def unambiguous_labels(labels: DataFrame, label: str) -> DataFrame:
    """One row (doc_id, label 0/1) per labelled document.

    Null ids and labels, labels other than 0 and 1, and documents with labels of both kinds are
    left out.
    """
    return (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("top"))
        .where(F.col("label") == F.col("top"))
        .drop("top")
    )


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))
