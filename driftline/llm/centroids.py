"""Lloyd rounds on whole-number vectors with dot products that are kept and only updated.

1. Entries become whole numbers; the start is the vectors of the least digests.
2. Each vector's dot products with all centroids are computed once, exact, and
   stored beside it.
3. A round takes the nearest centroid from them: the squared distance is, but for
   the vector's own square, the centroid's square less twice the dot product.
   Sums by cluster give the new centroids.
4. Only the components that a centroid changed are multiplied by what they
   changed, and added to the stored products. Centroids that stay cost nothing.

The driver holds the centroids and their changes, never vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.files import kept
from driftline.llm.vectors import blocks, named, scaled, whole

# Sums of products stay in 64 bits up to vectors of this many entries.
MOST, MOST_DIMS = 1 << 26, 1 << 9
STATE = "vec_id bigint, vector array<int>, square bigint, dots array<bigint>"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    first, last = column.offsets[0].as_py(), column.offsets[-1].as_py()
    return column.values.to_numpy()[first:last].astype(np.int64).reshape(-1, width)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.arange(len(matrix) + 1) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(matrix.ravel(), kind))


def whole_numbers(rows: DataFrame, dims: int, scale: int) -> DataFrame:
    """``vec_id, vector`` of the rows whose vector counts, each entry ``floor(scale * entry)``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, dims):
            at, matrix = whole(block.column("vector"), dims)
            numbers = scaled(matrix, scale, MOST)
            yield pa.RecordBatch.from_arrays([block.column("vec_id").take(pa.array(at)), _lists(numbers, pa.int32())], ["vec_id", "vector"])

    return rows.mapInArrow(each, "vec_id bigint, vector array<int>")


def first_centroids(numbers: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors of the ``k`` least digests of ``seed:id``, in that order; equal ids by their vectors, NULL ids last."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = numbers.select(digest.alias("digest"), "vector").orderBy(F.col("digest").asc_nulls_last(), "vector").limit(k)
    return np.array([row["vector"] for row in chosen.collect()], np.int64)


def first_dots(numbers: DataFrame, centroids: np.ndarray) -> DataFrame:
    sent = numbers.sparkSession.sparkContext.broadcast(centroids)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, sent.value.shape[1]):
            matrix = _matrix(block.column("vector"), sent.value.shape[1])
            squares, dots = (matrix * matrix).sum(axis=1), matrix @ sent.value.T
            yield pa.RecordBatch.from_arrays(
                [block.column("vec_id"), block.column("vector"), pa.array(squares), _lists(dots, pa.int64())],
                ["vec_id", "vector", "square", "dots"],
            )

    return numbers.mapInArrow(each, STATE)


def updated_dots(state: DataFrame, change: np.ndarray) -> DataFrame:
    """The state after centroids moved by ``change``; only the components that differ are read and multiplied."""
    moves = [(number, np.flatnonzero(row), row[np.flatnonzero(row)]) for number, row in enumerate(change) if row.any()]
    sent = state.sparkSession.sparkContext.broadcast(moves)
    k, dims = change.shape

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, dims):
            matrix, dots = _matrix(block.column("vector"), dims), _matrix(block.column("dots"), k)
            for number, places, by in sent.value:
                dots[:, number] += matrix[:, places] @ by
            yield pa.RecordBatch.from_arrays(
                [block.column("vec_id"), block.column("vector"), block.column("square"), _lists(dots, pa.int64())],
                ["vec_id", "vector", "square", "dots"],
            )

    return state.mapInArrow(each, STATE)


def _nearest(block: pa.RecordBatch, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, the smaller of equals, and the squared distance to it."""
    apart = squares - 2 * _matrix(block.column("dots"), len(squares))
    number = np.argmin(apart, axis=1)
    return number, apart[np.arange(len(number)), number] + block.column("square").to_numpy(zero_copy_only=False)


def moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of the mean of their vectors, unchanged where they have none.

    A task sends at most a row per centroid and component; those are summed up.
    """
    squares = (centroids * centroids).sum(axis=1)
    dims = centroids.shape[1]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for block in blocks(batches, dims):
            number, _ = _nearest(block, squares)
            matrix = _matrix(block.column("vector"), dims)
            for cluster in np.unique(number):
                sums[cluster] += matrix[number == cluster].sum(axis=0)
            sizes += np.bincount(number, minlength=len(sizes))
        on = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(on, dims), pa.int32()),
                pa.array(np.tile(np.arange(dims), len(on)), pa.int32()),
                pa.array(np.repeat(sizes[on], dims)),
                pa.array(sums[on].ravel()),
            ],
            ["cluster", "place", "size", "total"],
        )

    parts = state.select("vector", "square", "dots").mapInArrow(each, "cluster int, place int, size bigint, total bigint")
    new = centroids.copy()
    for row in parts.groupBy("cluster", "place").agg(F.sum("size").alias("size"), F.sum("total").alias("total")).collect():
        new[row["cluster"], row["place"]] = row["total"] // row["size"]
    return new


def assigned(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    squares = (centroids * centroids).sum(axis=1)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, len(squares)):
            number, distance = _nearest(block, squares)
            yield pa.RecordBatch.from_arrays(
                [block.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"]
            )

    return state.select("vec_id", "square", "dots").mapInArrow(each, "vec_id bigint, cluster int, distance bigint")


def cluster(rows: DataFrame, *, k: int, rounds: int, dims: int, scale: int, seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """``vec_id, cluster, distance`` of every vector that counts, and ``cluster, centroid, cluster_size, cluster_inertia`` of every centroid.

    A vector counts with exactly ``dims`` entries, none NULL or not finite.
    Distances are squared; of equally near centroids the one with the smaller
    number is taken. Fewer than ``k`` vectors, fewer centroids; none, two empty
    tables. Rows with one id or without an id are vectors of their own. A
    centroid that nothing is nearest to stays, with inertia 0. Rounds end early
    once no centroid moves. Entries of ``2**26 / scale`` or more are an error.
    """
    if not 0 < dims <= MOST_DIMS or k < 1:
        raise ValueError(f"from 1 to {MOST_DIMS} dimensions and at least one centroid")
    spark = rows.sparkSession
    numbers = whole_numbers(named(rows, id_col, vector_col), dims, scale)
    centroids = first_centroids(numbers, k, seed)
    kinds = "cluster int, centroid array<bigint>, cluster_size bigint, cluster_inertia bigint"
    if not len(centroids):
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), spark.createDataFrame([], kinds)
    state = kept(first_dots(numbers, centroids), "dots")
    for _ in range(rounds):
        new = moved(state, centroids)
        if (new == centroids).all():
            break
        state = kept(updated_dots(state, new - centroids), "dots")
        centroids = new
    placed = assigned(state, centroids)
    sums = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.sum("distance").alias("inertia"))
    of = {row["cluster"]: (row["size"], row["inertia"]) for row in sums.collect()}
    listed = [(number, centroid, *of.get(number, (0, 0))) for number, centroid in enumerate(centroids.tolist())]
    return placed, spark.createDataFrame(listed, kinds)
