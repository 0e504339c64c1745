"""Rows with usable vectors, and Arrow batches of equally long vectors as matrices."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_VALUES = 2_000_000  # values of a batch worked on at once


def finite(vector: Column) -> Column:
    """Whether the vector is there and holds neither null, NaN nor infinity."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == F.lit(math.inf)))
    return F.coalesce(~bad, F.lit(False))


def whole_steps(vector: Column, factor: int, shift: int = 0) -> Column:
    """Each entry as ``floor(factor * entry) + shift``, the entry as double."""
    return F.transform(vector, lambda c: F.floor(factor * c.cast("double")).cast("bigint") + shift)


def common_length(df: DataFrame, vector: str) -> int:
    """The length that most vectors have, the larger of equals; 0 without any."""
    counted = df.groupBy(F.size(vector).alias("n")).count()
    row = counted.orderBy(F.col("count").desc(), F.col("n").desc()).first()
    return row["n"] if row else 0


def matrices(batch: pa.RecordBatch, column: str, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """The batch's vectors as rows of int64 matrices of bounded size, each with the place of its first row."""
    vectors = batch.column(column)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(batch.num_rows, length)
    step = max(1, SLICE_VALUES // max(length, 1))
    for start in range(0, batch.num_rows, step):
        yield start, flat[start : start + step]
