"""Documents packed into sequences of a fixed number of tokens, by sums of squares.

1. Every document is encoded once. Longer ones are cut from the end, so only the
   first piece may be shorter; pieces as long as a sequence are one.
2. All others are dealt out to tasks in equal shares. A task places its pieces, the
   longest first, each into the open sequence after which the sum over all gaps of
   the squared number of open sequences with that gap is least; of equals into the
   fullest one. A new sequence is opened where no open one has room.
3. Full sequences are done. Pieces of all others are dealt out again to fewer
   tasks and packed anew, until one task's share is left.

Only numbers move between tasks; ids are fetched by ``sequences`` where they are wanted.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.files import kept
from driftline.llm.words import byte_words

CAPACITY = 1024
SHARE = 1 << 15
PIECES = "key bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACES = "sequence_id bigint, offset bigint"


def cuts(length: int, capacity: int) -> list[int]:
    """Where the pieces of a document begin, and its end."""
    first = length % capacity or capacity
    return [0, *range(first, length + 1, capacity)] if length else [0]


def pieces(docs: DataFrame, tokenizer_path: str, ranks_path: str, *, capacity: int = CAPACITY, end_id: int | None = None, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key, doc_id, piece, start, length, ids_crc32`` and, if wanted, ``ids`` of all documents, stored once.

    ``end_id`` is put after every document; NULL and empty texts have no other
    token, and no piece without it. ``key`` is a number of its own for every
    piece, so rows with one id or without an id are told apart. Whole texts are
    encoded. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    end = np.asarray([] if end_id is None else [end_id], np.uint32)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = byte_words(tokenizer_path, ranks_path)
        key = TaskContext.get().partitionId() << 36
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found, lists = [], []
                for doc, coded in zip(part.column("doc_id").to_pylist(), words.encode_all(part.column("text").to_pylist())):
                    ids = np.concatenate([coded, end]).astype("<u4", copy=False)
                    bounds = cuts(len(ids), capacity)
                    for number, (a, b) in enumerate(zip(bounds, bounds[1:])):
                        found.append((key, doc, number, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                        key += 1
                        if with_ids:
                            lists.append(ids[a:b].astype(np.int32))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                columns = [pa.array(column, kind) for column, kind in zip(zip(*found) if found else [[]] * 6, kinds)]
                names = ["key", "doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(lists, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return kept(rows.mapInArrow(each, PIECES + (", ids array<int>" if with_ids else "")), "pieces")


class Open:
    """Open sequences of a task by their level: how many there are, and which."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.opened = 0

    def place(self, length: int) -> tuple[int, int]:
        """The sequence a piece goes to, and its offset there.

        A sequence of level h that comes to level h + length changes the sum of
        squares by 2 (n[h + length] - n[h] + 1), by 1 less where it is full and
        leaves the sum.
        """
        before = self.counts[: self.capacity - length + 1]
        change = 2 * (self.counts[length:] - before)
        change[-1] -= 1
        change[before == 0] = np.iinfo(np.int64).max
        level = len(change) - 1 - int(np.argmin(change[::-1]))
        if before[level]:
            number = self.at[level].pop()
            self.counts[level] -= 1
        else:
            level, number = 0, self.opened
            self.opened += 1
        if level + length < self.capacity:
            self.at[level + length].append(number)
            self.counts[level + length] += 1
        return number, level


def pack(made: DataFrame, *, capacity: int = CAPACITY, share: int = SHARE) -> DataFrame:
    """The columns of ``made`` with ``sequence_id, offset``: where every piece is placed.

    ``made`` is a stored table with ``key`` and ``length``, from 1 to
    ``capacity``, as ``pieces`` gives it. Sequences have no gap from their begin
    on. Shares are dealt out by row, so no id, text or length is a hot key. No
    pieces, no sequences.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [batch for batch in batches if batch.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts).combine_chunks()
        lengths = rows.column("length").to_numpy()
        keys = rows.column("key").to_numpy()
        opened = Open(capacity)
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for row in np.lexsort((keys, -lengths)).tolist():
            sequence[row], offset[row] = opened.place(int(lengths[row]))
        level = np.bincount(sequence, weights=lengths, minlength=opened.opened).astype(np.int64)[sequence]
        base = TaskContext.get().partitionId() << 32
        for name, column in (("sequence_id", sequence + base), ("offset", offset), ("level", level)):
            rows = rows.append_column(name, pa.array(column, pa.int64()))
        yield from rows.to_batches()

    names = [name for name in made.columns if name != "ids"]
    kinds = ", ".join(f"{name} {kind}" for name, kind in made.select(*names).dtypes)
    done = made.filter(F.col("length") == capacity).select(*names, F.col("key").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rest = made.filter(F.col("length") < capacity).select(*names)
    left, turn = rest.count(), 0
    while left:
        turn += 1
        tasks = -(-left // share)
        placed = kept(rest.repartition(tasks).mapInArrow(place, f"{kinds}, {PLACES}, level bigint"), "placed")
        placed = placed.withColumn("sequence_id", F.col("sequence_id") + F.lit(turn << 56))
        rest = placed.filter(F.col("level") < capacity)
        before, left = left, rest.count()
        # One task has seen all that was left, or dealing them out anew no longer helps.
        ended = tasks == 1 or left > 0.95 * before
        done = done.unionByName((placed if ended else placed.filter(F.col("level") == capacity)).drop("level"))
        if ended:
            break
        rest = rest.select(*names)
    return done


def sequences(made: DataFrame, placed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids, offsets`` of every sequence; ``made`` must hold ids."""
    joined = placed.select("key", "doc_id", "sequence_id", "offset").join(made.select("key", "ids"), "key")
    grouped = joined.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"))
    return grouped.select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets")
    )
