"""Vectors out of Arrow batches, for work inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ENTRIES = 1 << 20


def named(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector``; no other column is looked at."""
    return rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))


def usual_length(rows: DataFrame) -> int | None:
    """The length that most vectors without a NULL have, the larger one of equally frequent ones; None without vectors."""
    lengths = rows.filter(F.col("vector").isNotNull()).groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    found = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return found["length"] if found else None


def whole(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows whose vector has ``dims`` entries, none of them NULL or not finite, and their entries as a matrix."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)
    fit = np.diff(offsets) == dims
    if column.null_count:
        fit &= column.is_valid().to_numpy(zero_copy_only=False)
    at = np.flatnonzero(fit)
    if not len(at) or not dims:
        return at, np.empty((len(at), dims))
    matrix = values[offsets[at][:, None] + np.arange(dims)].astype(np.float64, copy=False)
    finite = np.isfinite(matrix).all(axis=1)
    return at[finite], matrix[finite]


def scaled(matrix: np.ndarray, scale: int, most: int) -> np.ndarray:
    """``floor(scale * entry)`` as whole numbers; an error where one is ``most`` or more away from zero."""
    with np.errstate(over="ignore"):
        floors = np.floor(matrix * scale)
    if floors.size and np.abs(floors).max() >= most:
        raise ValueError(f"an entry times {scale} is {most} or more, beyond exact sums")
    return floors.astype(np.int64)


def blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of about a million entries, one row at least."""
    height = max(1, BLOCK_ENTRIES // max(1, dims))
    for batch in batches:
        for at in range(0, batch.num_rows, height):
            yield batch.slice(at, height)
