"""Co-occurrence of few terms in many documents, as sums in stripes of the matrix of terms by terms."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.session import shuffle_width, stage

# Sent along with the tasks, so workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Cells of a stripe, eight bytes each, and pairs that are added at a time.
CELLS = 1 << 24
PAIRS = 1 << 21


def add_pairs(sums: np.ndarray, low: int, sizes: np.ndarray, ids: np.ndarray, tfs: np.ndarray) -> None:
    """Add the product of counts for each two terms of a document to ``sums``, the rows of the matrix from ``low`` on; ids rise in a document."""
    ends = np.repeat(np.cumsum(sizes), sizes)
    first = np.flatnonzero((ids >= low) & (ids < low + len(sums)))
    later = ends[first] - first - 1
    total = np.cumsum(later)
    flat, width = sums.reshape(-1), sums.shape[1]
    i = 0
    while i < len(first):
        j = max(i + 1, int(np.searchsorted(total, total[i] - later[i] + PAIRS, "right")))
        met = later[i:j]
        a = np.repeat(first[i:j], met)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(met) - met, met)
        np.add.at(flat, (ids[a] - low) * width + ids[b], tfs[a] * tfs[b])
        i = j


def _unpacked(batch: pa.RecordBatch, kinds: dict[str, type]) -> Iterator[list[np.ndarray]]:
    for row in zip(*(batch.column(name).to_pylist() for name in kinds)):
        yield [np.frombuffer(value, kind).astype(np.int64) for value, kind in zip(row, kinds.values())]


def cooccurrence(lists: DataFrame, names: list[str]) -> DataFrame:
    """``a, b, weight`` in both directions, of documents packed as by ``grams.packed_terms_of_blocks``, terms by their places in ``names``.

    A task adds up one stripe of the matrix over a share of the documents, however
    many they are; a row of the matrix is then added up over the shares. What is
    stored is packed, and the rows given back are unpacked from it each time.
    """
    spark, n = lists.sparkSession, len(names)
    height = max(1, CELLS // max(1, n))
    stripes = max(1, -(-n // height))
    shares = -(-spark.sparkContext.defaultParallelism // stripes)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, sums = None, None

        def packed() -> Iterator[pa.RecordBatch]:
            for k in np.flatnonzero(sums.any(axis=1)).tolist():
                ends = np.flatnonzero(sums[k])
                columns = [pa.array([of * height + k], pa.int32()), pa.array([ends.astype(np.int32).tobytes()], pa.binary()), pa.array([sums[k, ends].tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["a", "ends", "weights"])

        for batch in batches:
            rows = _unpacked(batch, {"sizes": np.int32, "ids": np.int32, "tfs": np.int32})
            for stripe, row in zip(batch.column("stripe").to_pylist(), rows):
                if stripe != of:
                    if of is not None:
                        yield from packed()
                    of, sums = stripe, np.zeros((min(height, n - stripe * height), n), np.int64)
                add_pairs(sums, of * height, *row)
        if of is not None:
            yield from packed()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, sums = None, None

        def packed() -> pa.RecordBatch:
            ends = np.flatnonzero(sums)
            columns = [pa.array([of], pa.int32()), pa.array([ends.astype(np.int32).tobytes()], pa.binary()), pa.array([sums[ends].tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["a", "ends", "weights"])

        for batch in batches:
            for a, (ends, weights) in zip(batch.column("a").to_pylist(), _unpacked(batch, {"ends": np.int32, "weights": np.int64})):
                if a != of:
                    if of is not None:
                        yield packed()
                    of, sums = a, np.zeros(n, np.int64)
                sums[ends] += weights
        if of is not None:
            yield packed()

    dealt = lists.withColumn("share", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shares)).cast("int"))
    dealt = dealt.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    dealt = dealt.repartition(stripes * shares, "stripe", "share").sortWithinPartitions("stripe")
    rows = dealt.select("stripe", "sizes", "ids", "tfs").mapInArrow(add, "a int, ends binary, weights binary")
    placed = rows.repartition(shuffle_width(spark), "a").sortWithinPartitions("a")
    stored = stage(placed.mapInArrow(total, "a int, ends binary, weights binary"))
    sent = spark.sparkContext.broadcast(names)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = pa.array(sent.value, pa.string())
        for batch in batches:
            for a, (ends, weights) in zip(batch.column("a").to_pylist(), _unpacked(batch, {"ends": np.int32, "weights": np.int64})):
                a, b, weights = texts.take(pa.array(np.full(len(ends), a))), texts.take(pa.array(ends)), pa.array(weights)
                for x, y in ((a, b), (b, a)):
                    yield pa.RecordBatch.from_arrays([x, y, weights], ["a", "b", "weight"])

    return stored.mapInArrow(unpack, "a string, b string, weight long")
