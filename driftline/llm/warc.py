"""Web archives with a two-level capture index.

Records are gzip members of their own in archive files. The index holds a line per
capture, sorted by the reversed-host key of its address, in compressed blocks; a
sparse directory beside each index file has the first key and place of every block.
A lookup finds the file, the block and the line by binary search, then reads just
the record's bytes.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.files import kept, open_file, written_once

ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 512
DATE = "1970-01-01T00:00:00Z"


def url_key(url: str | None) -> str:
    """Host labels in reverse, then path and query: ``com,example,www)/a?b``. No address gives ``)``."""
    safe = quote(url or "", safe="".join(chr(c) for c in range(0x21, 0x7F)))
    try:
        parts = urlsplit(safe if "//" in safe else f"//{safe}")
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return f"){safe}"
    default = {"http": 80, "https": 443}.get(parts.scheme)
    at = ",".join(reversed(host.split("."))) + (f":{port}" if port and port != default else "")
    return f"{at}){parts.path or '/'}{'?' + parts.query if parts.query else ''}" if host else f"){safe}"


def sort_key(key: str, page_id: int | None) -> str:
    """One text per capture that sorts by key, then page id, NULL first."""
    number = 0 if page_id is None else page_id + (1 << 63) + 1
    return f"{key} {number:020d}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, *, is_revisit: bool, date: str = DATE) -> bytes:
    """The bytes of one record: a response with its payload, or a revisit with the headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode("ascii")
    block = http if is_revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url or '', safe=''.join(chr(c) for c in range(0x21, 0x7F)))}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
    ]
    if is_revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("ascii") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """What a record says; a response's payload is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("ascii").split("\r\n")[1:] if ": " in line)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def number(text: str) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", text)
        return int(found[1]) if found else None

    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI", ""),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number(fields["WARC-Refers-To"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


# Packed bytes of records that a task reads, and captures to a file of the index.
READ_BYTES = 64 << 20
INDEX_LINES = 1 << 20

CAPTURES = "key string, page_id bigint, file string, offset bigint, length bigint"


def write_archives(pages: DataFrame, folder: str, *, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``page_id, url, html`` and return where each is: ``key, page_id, file, offset, length``.

    Of rows with equal payloads of at least ``min_bytes``, the one with the largest
    ``page_id`` is the response and the others revisit it; shorter payloads are all
    responses. A NULL html is an empty payload, a NULL id counts as the smallest.
    Rows with equal payload that all have the largest id are one page given twice
    and all responses. The largest id is a maximum summed up before the shuffle;
    only payloads met twice are joined back, which adaptive execution may split.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    shared = (
        rows.filter(F.octet_length("html") >= min_bytes)
        .select("sha", "page_id")
        .groupBy("sha")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .select("sha", "keeper")
    )
    decided = rows.join(shared, "sha", "left").select(
        "page_id", "url", "html", (~F.col("page_id").eqNullSafe(F.col("keeper")) & F.col("keeper").isNotNull()).alias("is_revisit"), "keeper"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The attempt is part of the name: places are valid for the files of the attempt that counts.
        task = TaskContext.get()
        seq, done = 0, False
        source = (row for batch in batches for at in range(0, batch.num_rows, 200) for row in batch.slice(at, 200).to_pylist())
        row = next(source, None)
        while row is not None:
            name = f"archive-{task.partitionId():07d}-{task.taskAttemptId():09d}-{seq:05d}.warc.gz"
            placed, at = [], 0
            with written_once(folder, name) as out:
                while row is not None and at < archive_bytes:
                    raw = record(row["page_id"], row["url"], row["html"].encode("utf-8"), row["keeper"], is_revisit=row["is_revisit"])
                    member = gzip.compress(raw, 6, mtime=0)
                    out.write(member)
                    placed.append((url_key(row["url"]), row["page_id"], name, at, len(member)))
                    at += len(member)
                    row = next(source, None)
            seq += 1
            columns = [pa.array(column, kind) for column, kind in zip(zip(*placed), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "page_id", "file", "offset", "length"])

    return kept(decided.mapInArrow(write, CAPTURES), "captures")


def write_index(captures: DataFrame, folder: str, *, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the index of captures; returns ``name, first, last`` of its files, a row per file.

    Captures are dealt out by ranges of key and page id, so a host or address with
    any number of captures is cut among files. NULL addresses and ids have keys of
    their own. Equal keys keep a line each. No captures, no files.
    """

    def with_sort_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [sort_key(k, p) for k, p in zip(batch.column("key").to_pylist(), batch.column("page_id").to_pylist())]
            lines = [
                json.dumps([key, *rest]) for key, *rest in zip(keys, *(batch.column(name).to_pylist() for name in ("file", "offset", "length")))
            ]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(lines, pa.string())], ["sort", "line"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"index-{TaskContext.get().partitionId():07d}"
        held: list[tuple[str, str]] = []
        directory, at, last = [], 0, None
        with written_once(folder, f"{name}.gz") as out:

            def close() -> None:
                nonlocal at, last, held
                member = gzip.compress("\n".join(line for _, line in held).encode("utf-8"), 6, mtime=0)
                directory.append([held[0][0], at, len(member)])
                out.write(member)
                at, last, held = at + len(member), held[-1][0], []

            for batch in batches:
                for pair in zip(batch.column("sort").to_pylist(), batch.column("line").to_pylist()):
                    held.append(pair)
                    if len(held) == block_lines:
                        close()
            if held:
                close()
        if directory:
            with written_once(folder, f"{name}.directory") as out:
                out.write("\n".join(json.dumps(entry) for entry in directory).encode("utf-8"))
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([directory[0][0]]), pa.array([last])], ["name", "first", "last"])

    keyed = captures.mapInArrow(with_sort_key, "sort string, line string")
    dealt = keyed.repartitionByRange(_tasks(captures, F.count(F.lit(1)), INDEX_LINES), "sort").sortWithinPartitions("sort", "line")
    return kept(dealt.mapInArrow(write, "name string, first string, last string"), "index-files")


class Index:
    """Binary search through index files; keeps the blocks and directories used last."""

    def __init__(self, folder: str, files: list[tuple[str, str, str]]) -> None:
        self.folder, self.files = folder, sorted(files, key=lambda row: row[1])
        self.lasts = [row[2] for row in self.files]
        self.directories: OrderedDict[str, list] = OrderedDict()
        self.blocks: OrderedDict[tuple, list] = OrderedDict()

    def _directory(self, name: str) -> list:
        if name not in self.directories:
            with open_file(self.folder, f"{name}.directory") as source:
                self.directories[name] = [json.loads(line) for line in source.read().decode("utf-8").split("\n")]
            if len(self.directories) > 4:
                self.directories.popitem(last=False)
        return self.directories[name]

    def _block(self, name: str, at: int, size: int) -> list:
        if (name, at) not in self.blocks:
            with open_file(self.folder, f"{name}.gz") as source:
                source.seek(at)
                lines = gzip.decompress(source.read(size)).decode("utf-8").split("\n")
            self.blocks[name, at] = [json.loads(line) for line in lines]
            if len(self.blocks) > 4:
                self.blocks.popitem(last=False)
        return self.blocks[name, at]

    def find(self, low: str, high: str) -> Iterator[tuple[str, int, int]]:
        """Places of the captures whose sort key lies between the bounds, both included."""
        for place in range(bisect_left(self.lasts, low), len(self.files)):
            name, first, _ = self.files[place]
            if first > high:
                return
            directory = self._directory(name)
            firsts = [entry[0] for entry in directory]
            for entry in directory[max(0, bisect_left(firsts, low) - 1) : bisect_right(firsts, high)]:
                lines = self._block(name, entry[1], entry[2])
                for line in lines[bisect_left(lines, low, key=lambda x: x[0]) :]:
                    if line[0] > high:
                        break
                    yield line[1], line[2], line[3]


def locate(keys: DataFrame, folder: str, files: DataFrame) -> DataFrame:
    """``file, offset, length`` of the captures with the keys in ``low, high`` (bounds of sort keys).

    Keys are dealt out by range, so a task meets neighbouring blocks. The list of
    index files has a row per file and goes to the tasks with the code.
    """
    listed = [tuple(row) for row in files.select("name", "first", "last").collect()]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(folder, listed)
        for batch in batches:
            found = [place for low, high in zip(batch.column("low").to_pylist(), batch.column("high").to_pylist()) for place in index.find(low, high)]
            columns = zip(*found) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()))], ["file", "offset", "length"])

    dealt = keys.select("low", "high").distinct().repartitionByRange("low").sortWithinPartitions("low")
    return dealt.mapInArrow(search, "file string, offset bigint, length bigint")


RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def _tasks(rows: DataFrame, amount: Column, each: int) -> int:
    """So many tasks that each has about ``each`` of an amount summed over the rows, and as many as there are cores where that is less work for one."""
    total = rows.agg(amount).first()[0] or 0
    return max(1, -(-total // each), min(rows.sparkSession.sparkContext.defaultParallelism, -(-16 * total // each)))


def read_records(places: DataFrame, folder: str) -> DataFrame:
    """The records at ``file, offset, length``, each read by its own range of bytes, in the order of the file.

    A place given twice is read twice. No places, no records.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
            + [("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
        )
        name, source = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                out = []
                for row in batch.slice(at, 200).to_pylist():
                    if row["file"] != name:
                        if source:
                            source.close()
                        name, source = row["file"], open_file(folder, row["file"])
                    source.seek(row["offset"])
                    out.append(parse(gzip.decompress(source.read(row["length"]))))
                yield pa.RecordBatch.from_pylist(out, schema)
        if source:
            source.close()

    # A file is cut by offset as well, so that one large file is read by many tasks.
    # The list of places is short for what it stands for, so their number of tasks goes by the bytes to be read.
    places = kept(places, "places")
    tasks = _tasks(places, F.sum("length"), READ_BYTES)
    dealt = places.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(read, RECORDS)


def lookup(spark: SparkSession, folder: str, files: DataFrame, urls: list[str]) -> DataFrame:
    """All records of some addresses."""
    keys = [url_key(url) for url in urls]
    bounds = spark.createDataFrame([(f"{key} ", f"{key} ~") for key in keys], "low string, high string")
    return read_records(locate(bounds, folder, files), folder)


def page_keys(pages: DataFrame) -> DataFrame:
    """Bounds of the captures of each page by address and id; equal for rows that have both in common, and for NULLs like any other."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array([sort_key(url_key(u), p) for u, p in zip(batch.column("url").to_pylist(), batch.column("page_id").to_pylist())], pa.string())
            yield pa.RecordBatch.from_arrays([keys, keys], ["low", "high"])

    return pages.select("url", "page_id").mapInArrow(keyed, "low string, high string")
