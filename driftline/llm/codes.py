"""Token ids as files of directly addressable codes.

An id is cut into chunks of eight bits, the lowest first. Level k of a file holds
chunk k of all ids that have one, in order; a bitmap beside it says which of them
go on at the next level, and a rank directory counts the set bits up to every
512th. The place of id i at the next level is the rank of its bit, so any id is
read from a few bytes without decoding what stands before it.

File: magic, counts, ids of the documents, first token of each document and the
end, then per level its count, chunks, bitmap and rank directory. All numbers are
little-endian.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.llm.files import kept, open_file, written_once
from driftline.llm.words import byte_words

MAGIC = b"ADDRCODE"
RANK_BITS = 512
FILE_TOKENS = 1 << 23


def levels_of(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per level its chunks, packed continuation bits and rank directory."""
    levels = []
    rest = ids.astype(np.uint32)
    while True:
        chunks = (rest & 0xFF).astype(np.uint8)
        on = rest > 0xFF
        bits = np.packbits(on, bitorder="little")
        padded = np.zeros(-(-len(on) // RANK_BITS) * RANK_BITS, dtype=bool)
        padded[: len(on)] = on
        ranks = np.concatenate([[0], np.cumsum(padded.reshape(-1, RANK_BITS).sum(axis=1))]).astype("<u8")
        levels.append((chunks, bits, ranks))
        rest = rest[on] >> 8
        if not len(rest):
            return levels


def write_file(out, doc_ids: list[int | None], lists: list[np.ndarray]) -> None:
    ids = np.concatenate(lists) if lists else np.empty(0, np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype("<u8")
    levels = levels_of(ids)
    out.write(MAGIC + struct.pack("<QQQ", len(doc_ids), len(ids), len(levels)))
    out.write(np.asarray([doc is None for doc in doc_ids], dtype=np.uint8).tobytes())
    out.write(np.asarray([doc or 0 for doc in doc_ids], dtype="<i8").tobytes())
    out.write(bounds.tobytes())
    for chunks, bits, ranks in levels:
        out.write(struct.pack("<Q", len(chunks)))
        for part in (chunks, bits, ranks):
            out.write(part.tobytes())


class CodeFile:
    """Random access to a written file: only the places that are asked for are read."""

    def __init__(self, source) -> None:
        self.source = source
        if self._read(0, 8) != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self.n_docs, self.n_tokens, n_levels = struct.unpack("<QQQ", self._read(8, 24))
        at = 32
        self.null_at, self.docs_at, self.bounds_at = at, at + self.n_docs, at + 9 * self.n_docs
        at = self.bounds_at + 8 * (self.n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            (count,) = struct.unpack("<Q", self._read(at, 8))
            bits = -(-count // 8)
            ranks = -(-count // RANK_BITS) + 1
            self.levels.append((count, at + 8, at + 8 + count, at + 8 + count + bits))
            at += 8 + count + bits + 8 * ranks

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def documents(self):
        """Ids of the documents (None for NULL) and the first token of each, and the end."""
        null = self._read(self.null_at, self.n_docs)
        docs = np.frombuffer(self._read(self.docs_at, 8 * self.n_docs), "<i8")
        bounds = np.frombuffer(self._read(self.bounds_at, 8 * (self.n_docs + 1)), "<u8").astype(np.int64)
        return [None if none else int(doc) for none, doc in zip(null, docs)], bounds

    def _rank(self, level: int, place: int) -> int:
        """Set bits of a level ahead of ``place``."""
        _, _, bits_at, ranks_at = self.levels[level]
        block = place // RANK_BITS
        (before,) = struct.unpack("<Q", self._read(ranks_at + 8 * block, 8))
        first = block * RANK_BITS
        if place == first:
            return before
        packed = np.frombuffer(self._read(bits_at + first // 8, -(-(place - first) // 8)), np.uint8)
        return before + int(np.unpackbits(packed, bitorder="little")[: place - first].sum())

    def slice(self, begin: int, end: int) -> np.ndarray:
        """Ids from place ``begin`` up to ``end``."""
        if not 0 <= begin <= end <= self.n_tokens:
            raise IndexError((begin, end))
        if begin == end:
            return np.empty(0, np.uint32)
        found = np.zeros(end - begin, np.uint32)
        places = np.arange(end - begin)
        for level, (_, chunks_at, bits_at, _) in enumerate(self.levels):
            chunks = np.frombuffer(self._read(chunks_at + begin, end - begin), np.uint8)
            found[places] |= chunks.astype(np.uint32) << np.uint32(8 * level)
            first = begin // 8
            packed = np.frombuffer(self._read(bits_at + first, -(-end // 8) - first), np.uint8)
            on = np.unpackbits(packed, bitorder="little")[begin - 8 * first : end - 8 * first].astype(bool)
            places = places[on]
            if not len(places):
                break
            begin = self._rank(level, begin)
            end = begin + len(places)
        return found

    def token(self, place: int) -> int:
        return int(self.slice(place, place + 1)[0])


def write_codes(docs: DataFrame, folder: str, tokenizer_path: str, ranks_path: str, *, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text", file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write the ids of all texts, in ascending order of their documents, and return the list of files.

    ``name, base, n_docs, n_tokens``, ``base`` being the tokens of all files before.
    ``end_id`` is put after every document. Texts are dealt out by ranges of the id
    and sorted, so the files' names sort as the ids in them do; NULL ids come first,
    equal ids in the order of their texts. NULL and empty texts have no ids but the
    end. A file is closed after ``file_tokens`` at a document's end, which bounds
    what a task holds. No documents, no files.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = byte_words(tokenizer_path, ranks_path)
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids, lists, held, rows = [], [], 0, []

        def close() -> None:
            nonlocal doc_ids, lists, held, seq
            name = f"part-{part:07d}-{seq:05d}.codes"
            with written_once(folder, name) as out:
                write_file(out, doc_ids, lists)
            rows.append({"name": name, "n_docs": len(doc_ids), "n_tokens": held})
            doc_ids, lists, held, seq = [], [], 0, seq + 1

        end = np.asarray([] if end_id is None else [end_id], np.uint32)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part_of = batch.slice(at, 500)
                for doc, coded in zip(part_of.column("id").to_pylist(), words.encode_all(part_of.column("text").to_pylist())):
                    ids = np.concatenate([coded, end])
                    doc_ids.append(doc)
                    lists.append(ids)
                    held += len(ids)
                    if held >= file_tokens:
                        close()
        if doc_ids:
            close()
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("name", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    # Rows of one id, or without one, are cut by how their texts begin, so none is a hot key.
    known = F.col("id").asc_nulls_first()
    dealt = named.repartitionByRange(known, F.substring("text", 1, 100)).sortWithinPartitions(known, "text")
    files = kept(dealt.mapInArrow(write, "name string, n_docs bigint, n_tokens bigint"), "code-files")
    # One row per file, not per document.
    before = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("name", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"), "n_docs", "n_tokens")


def read_codes(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """``doc_id, start, ids`` of all documents in the files; ``start`` counts the ids of all documents before."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(folder, row["name"]) as source:
                    codes = CodeFile(source)
                    docs, bounds = codes.documents()
                    first = 0
                    while first < len(docs):
                        # As many documents at a time as have a million ids, one at least.
                        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + (1 << 20), side="right")) - 1)
                        ids = codes.slice(int(bounds[first]), int(bounds[last]))
                        offsets = (bounds[first : last + 1] - bounds[first]).astype(np.int32)
                        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int64).astype(np.int32)))
                        starts = pa.array(bounds[first:last] + row["base"], pa.int64())
                        yield pa.RecordBatch.from_arrays([pa.array(docs[first:last], pa.int64()), starts, lists], ["doc_id", "start", "ids"])
                        first = last

    width = max(1, spark.sparkContext.defaultParallelism)
    dealt = files.select("name", "base").repartition(max(width, int(spark.conf.get("spark.sql.shuffle.partitions"))), "name")
    return dealt.mapInArrow(read, "doc_id bigint, start bigint, ids array<int>")


def with_crc(coded: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of ids read back."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            crcs = [zlib.crc32(values[offsets[i] : offsets[i + 1]].tobytes()) for i in range(batch.num_rows)]
            sizes = pa.array(np.diff(offsets).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), sizes, pa.array(crcs, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return coded.mapInArrow(digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
