"""Whitening of vectors on the leading eigenvectors of their covariance.

1. Entries become whole numbers, ``floor(scale * entry) + shift``; their number,
   their sums and their covariance are gathered in one pass. Every block is
   centred on its own means before it is multiplied; blocks are joined by what
   their means differ. Sums are exact.
2. The covariance has the size of one vector squared and is split on the driver,
   see ``spectral``.
3. Means and axes are sent to all tasks, which whiten row by row.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from driftline.llm.spectral import EPS, leading
from driftline.llm.vectors import blocks, named, scaled, usual_length, whole

SCALE, SHIFT = 1024, 100_000
MOST = 1 << 52
MERGERS = 16


@dataclass(frozen=True)
class Moments:
    """Rows, sums by dimension (exact where rows hold whole numbers), and the sum of products of what rows differ from the means."""

    n: int
    sums: tuple
    spread: np.ndarray

    @property
    def means(self) -> np.ndarray:
        return np.array([total / self.n for total in self.sums], np.float64)

    def __add__(self, other: Moments) -> Moments:
        apart = self.means - other.means
        between = np.outer(apart, apart) * (self.n * (other.n / (self.n + other.n)))
        return Moments(self.n + other.n, tuple(a + b for a, b in zip(self.sums, other.sums)), self.spread + other.spread + between)

    @property
    def covariance(self) -> np.ndarray:
        return self.spread / self.n


def of_block(matrix: np.ndarray) -> Moments:
    sums = tuple(matrix.sum(axis=0).tolist())
    centred = matrix - np.array([total / len(matrix) for total in sums], np.float64)
    return Moments(len(matrix), sums, centred.T @ centred)


def gathered(rows: DataFrame, matrices: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]) -> Moments | None:
    """Moments of the matrices of all batches; None if they have no row.

    A task sends one row. Those are joined by a few tasks, in the order of the
    tasks they came from, and then by one that gets a row from each of these.
    """

    def sent(place: int, total: Moments | None) -> Iterator[pa.RecordBatch]:
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([place], pa.int64()), pa.array([pickle.dumps(total)], pa.binary())], ["place", "moments"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for matrix in matrices(batches):
            if len(matrix):
                total = of_block(matrix) if total is None else total + of_block(matrix)
        yield from sent(TaskContext.get().partitionId(), total)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = None, 0
        for batch in batches:
            for place, packed in zip(batch.column("place").to_pylist(), batch.column("moments").to_pylist()):
                part = pickle.loads(packed)
                first = place if total is None else first
                total = part if total is None else total + part
        yield from sent(first, total)

    schema = "place bigint, moments binary"
    parts = rows.mapInArrow(each, schema)
    some = parts.repartition(MERGERS, "place").sortWithinPartitions("place").mapInArrow(joined, schema)
    last = some.repartition(1).sortWithinPartitions("place").mapInArrow(joined, schema).first()
    return pickle.loads(last["moments"]) if last else None


@dataclass(frozen=True)
class Whitening:
    """What was learned: rows, exact sums, eigenvalues by size, unit axes as columns, and the sum of all eigenvalues."""

    n: int
    sums: tuple
    values: np.ndarray
    axes: np.ndarray
    trace: float
    scale: int
    shift: int

    @property
    def dims(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> list[float | None]:
        return [value / self.trace if self.trace > 0 else None for value in self.values.tolist()]

    @property
    def spread_axes(self) -> np.ndarray:
        """Which axes have a variance above rounding."""
        return self.values > 4 * self.dims * EPS * self.trace

    def apart(self, matrix: np.ndarray) -> np.ndarray:
        """``n * x - S`` of rows of whole numbers, exact."""
        largest = max(int(np.abs(matrix).max(initial=0)) * self.n, *(abs(total) for total in self.sums), 0)
        exact = matrix if largest < 1 << 61 else matrix.astype(object)
        return exact * self.n - np.array(self.sums, exact.dtype)

    def apply(self, apart: np.ndarray) -> np.ndarray:
        """Whitened rows; axes without variance give NaN."""
        centred = apart.astype(np.float64) / self.n
        roots = np.sqrt(np.where(self.spread_axes, self.values, np.nan))
        return centred @ self.axes / roots


def squares(apart: np.ndarray) -> list[int]:
    """The exact sum of squares of every row of whole numbers."""
    if apart.dtype == object:
        return [sum(int(x) ** 2 for x in row) for row in apart]
    largest = int(np.abs(apart).max(initial=0))
    dims = max(1, apart.shape[1])
    if largest**2 * dims < 1 << 63:
        return (apart * apart).sum(axis=1).tolist()
    if largest >= 1 << 48 or dims >= 1 << 14:
        return squares(apart.astype(object))
    high, low = apart >> 24, apart & ((1 << 24) - 1)
    parts = [(x * y).sum(axis=1).tolist() for x, y in ((high, high), (high, low), (low, low))]
    return [(hh << 48) + (hl << 25) + ll for hh, hl, ll in zip(*parts)]


def _numbers(rows: DataFrame, dims: int, scale: int, shift: int):
    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for block in blocks(batches, dims):
            yield scaled(whole(block.column("vector"), dims)[1], scale, MOST) + shift

    return matrices


def fit(rows: DataFrame, *, most: int = 8, scale: int = SCALE, shift: int = SHIFT, dims: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening | None:
    """Learn from every vector; None where there is none.

    NULL vectors and those with a NULL or an entry that is not finite do not
    count, nor do those of another length than ``dims``, by default the usual
    one. Vectors given twice count twice. Entries of ``2**52 / scale`` or more
    are an error, as sums would not be exact.
    """
    vectors = named(rows, id_col, vector_col)
    dims = usual_length(vectors) if dims is None else dims
    if not dims:
        return None
    found = gathered(vectors.select("vector"), _numbers(vectors, dims, scale, shift))
    if found is None:
        return None
    covariance = (found.covariance + found.covariance.T) / 2
    values, axes = leading(covariance, most)
    return Whitening(found.n, found.sums, np.maximum(values, 0.0), axes, math.fsum(np.diag(covariance)), scale, shift)


def whiten(rows: DataFrame, model: Whitening, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, deviation, whitened`` of every row whose vector counts.

    ``deviation`` is the exact sum of ``(n * x - S)**2``; ``whitened`` has one
    number per axis, NULL where the axis has no variance. Rows without an id or
    with one id stay rows of their own.
    """
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        width = len(model.values)
        for block in blocks(batches, model.dims):
            at, matrix = whole(block.column("vector"), model.dims)
            apart = model.apart(scaled(matrix, model.scale, MOST) + model.shift)
            flat = pa.array(model.apply(apart).ravel(), pa.float64(), from_pandas=True)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * width, pa.int32()), flat)
            exact = pa.array([Decimal(number) for number in squares(apart)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([block.column("vec_id").take(pa.array(at)), exact, lists], ["vec_id", "deviation", "whitened"])

    return named(rows, id_col, vector_col).mapInArrow(each, "vec_id bigint, deviation decimal(38,0), whitened array<double>")


def identity_error(rows: DataFrame, model: Whitening, *, id_col: str = "vec_id", vector_col: str = "embedding") -> float | None:
    """The largest entry of the whitened vectors' measured covariance minus the identity; None without an axis that has variance."""
    on = np.flatnonzero(model.spread_axes)
    if not len(on):
        return None
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        model = sent.value
        for block in blocks(batches, model.dims):
            numbers = scaled(whole(block.column("vector"), model.dims)[1], model.scale, MOST) + model.shift
            yield model.apply(model.apart(numbers))[:, on]

    found = gathered(named(rows, id_col, vector_col).select("vector"), matrices)
    return float(np.abs(found.covariance - np.eye(len(on))).max())
