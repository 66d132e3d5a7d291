"""Sums of vectors over all rows: each task adds up its Arrow batches, and Spark adds the tasks' sums by index."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summed(df: DataFrame, of: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum of of(batch) over all batches of df. Tasks send size numbers at most, and so many come to the driver."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += of(batch)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held], pa.float64())], names=["k", "x"])

    out = np.zeros(size)
    for row in df.mapInArrow(add, "k int, x double").groupBy("k").agg(F.sum("x").alias("x")).collect():
        out[row["k"]] = row["x"]
    return out


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists of width numbers as an array of rows; null lists and numbers are NaN."""
    column = column.cast(pa.list_(pa.float64()))
    if not column.null_count and len(values := column.flatten()) == width * len(column):
        return np.asarray(values.to_numpy(zero_copy_only=False), float).reshape(-1, width)
    return np.array([[np.nan if x is None else x for x in row] if row is not None else [np.nan] * width for row in column.to_pylist()], float).reshape(-1, width)


def lists(x: np.ndarray) -> pa.Array:
    """Rows of an array as a column of lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
