"""Removal of passages of many words that occur again anywhere, by super-k-mers.

A window is ``window`` consecutive words. Its minimiser is the least hash of the
runs of ``m`` words in it, so equal windows have equal minimisers. Consecutive
windows whose minimiser lies at the same place make up one packed string.

1. Places of the packed strings with their minimisers; a minimiser met once in
   the whole corpus has no repeated window.
2. Packed strings with a minimiser met again are taken from the texts and equal
   ones merged: if there are two of one, all its windows are repeated.
3. Different packed strings travel to the bucket of their minimiser, where their
   windows are sorted and counted. The strings of a bucket of more than
   ``bucket_strings`` are cut again by minimisers of another hash, and equal parts
   merged, as before; after ``LEVELS`` hashes the windows of what is left are dealt
   out and counted by their own digests.
4. Repeated windows go back to the texts they come from.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.files import kept
from driftline.llm.shingles import in_use, mix, runs, word_hashes, words_of

RUN_WORDS = 5
BUCKET_STRINGS = 256
LEVELS = 3


def first_minima(values: np.ndarray, span: int) -> np.ndarray:
    """Place of the least of every ``span`` consecutive values, the first of equal ones, from spans that double."""
    place, width = np.arange(len(values), dtype=np.int32), 1
    least = values
    while width < span:
        # Two spans of this width, side by side or overlapping, make up the next one.
        step = min(width, span - width)
        first = least[:-step] <= least[step:]
        least, place = np.where(first, least[:-step], least[step:]), np.where(first, place[:-step], place[step:])
        width += step
    return place


def packed_runs(hashes: np.ndarray, window: int, m: int, level: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and minimiser of each packed string, from the hashes of a text's words.

    Every level has a hash of its own.
    """
    if len(hashes) < window:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    grams = runs(hashes, m)
    if level:
        grams = mix(grams + np.uint64(level))
    place = first_minima(grams, window - m + 1)
    begins = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    sizes = np.diff(begins, append=len(place))
    return begins, sizes, grams[place[begins]].view(np.int64)


def repeated_in(strings: list[tuple[bytes, int]], window: int) -> list[list[int]]:
    """Per packed string the windows that occur twice or more among all of them; a string counts as often as it says."""
    placed = []
    for number, (packed, often) in enumerate(strings):
        words = packed.split(b" ")
        placed += [(b" ".join(words[i : i + window]), number, i, often) for i in range(len(words) - window + 1)]
    placed.sort()
    found: list[list[int]] = [[] for _ in strings]
    for _, equal in groupby(placed, key=lambda item: item[0]):
        equal = list(equal)
        if sum(item[3] for item in equal) > 1:
            for _, number, i, _ in equal:
                found[number].append(i)
    return found


def _key(packed: bytes) -> tuple[int, int]:
    high, low = np.frombuffer(xxhash.xxh128_digest(packed), np.int64)
    return int(high), int(low)


def _verdicts(rows: DataFrame, window: int, m: int, bucket_strings: int, level: int = 1) -> DataFrame:
    """``high, low, repeated`` of the packed strings with a repeated window; NULL says that all are.

    ``rows`` is stored and has ``least, high, low, often, packed``; equal strings are
    summed up before they are shuffled, and one of each stays.
    """
    strings = rows.groupBy("least", "high", "low").agg(F.sum("often").alias("often"))
    per_bucket = strings.groupBy("least").agg(F.count(F.lit(1)).alias("strings")).filter("strings > 1")
    one_each = rows.groupBy("least", "high", "low").agg(F.sum("often").alias("often"), F.first("packed").alias("packed"))
    open_strings = kept(one_each.join(per_bucket.hint("merge"), "least"), "open-strings")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []

        def done() -> pa.RecordBatch:
            found = repeated_in([(row["packed"], row["often"]) for row in held], window)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([row["high"] for row in held], pa.int64()),
                    pa.array([row["low"] for row in held], pa.int64()),
                    pa.array(found, pa.list_(pa.int32())),
                ],
                ["high", "low", "repeated"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                for row in batch.slice(at, 500).to_pylist():
                    if held and row["least"] != bucket:
                        yield done()
                        held = []
                    bucket = row["least"]
                    held.append(row)
        if held:
            yield done()

    in_bucket = (
        open_strings.filter(F.col("strings") <= bucket_strings).drop("strings").repartition("least").sortWithinPartitions("least")
        .mapInArrow(count, "high bigint, low bigint, repeated array<int>")
    )
    found = in_bucket.filter(F.size("repeated") > 0)
    crowded = open_strings.filter(F.col("strings") > bucket_strings).select("least", "high", "low", "often", "packed")
    if not crowded.isEmpty():
        found = found.unionByName((_by_parts if level < LEVELS else _by_windows)(crowded, window, m, bucket_strings, level))
    alone = strings.filter("often = 1").select("high", "low")
    whole = strings.filter("often > 1").select("high", "low", F.lit(None).cast("array<int>").alias("repeated"))
    return whole.unionByName(found.join(alone, ["high", "low"], "left_semi"))


def _by_parts(strings: DataFrame, window: int, m: int, bucket_strings: int, level: int) -> DataFrame:
    """Repeated windows of the strings of crowded buckets, from their parts under the hash of the next level."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_use()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows, columns = [], [[] for _ in range(6)]
                for i, (bucket, packed) in enumerate(zip(part.column("least").to_pylist(), part.column("packed").to_pylist())):
                    words = packed.split(b" ")
                    for first, n, least in zip(*(x.tolist() for x in packed_runs(word_hashes(words), window, m, level))):
                        piece = b" ".join(words[first : first + n + window - 1])
                        # Parts meet within the bucket their string is from.
                        inner = int(mix(np.array([bucket], np.int64).view(np.uint64) + np.array([least], np.int64).view(np.uint64) * np.uint64(3)).view(np.int64)[0])
                        rows.append(i)
                        for column, value in zip(columns, (first, n, inner, *_key(piece), piece)):
                            column.append(value)
                taken = pa.array(rows, pa.int64())
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(name).take(taken) for name in ("high", "low", "often")),
                        *(pa.array(column, kind) for column, kind in zip(columns, kinds)),
                    ],
                    ["outer_high", "outer_low", "often", "first", "n", "least", "high", "low", "packed"],
                )

    schema = "outer_high bigint, outer_low bigint, often bigint, first int, n int, least bigint, high bigint, low bigint, packed binary"
    parts = kept(strings.mapInArrow(cut, schema), "parts")
    verdicts = _verdicts(parts, window, m, bucket_strings, level + 1)
    places = F.coalesce("repeated", F.sequence(F.lit(0), F.col("n") - 1))
    met = parts.drop("packed", "often", "least").join(verdicts, ["high", "low"])
    moved = met.select(F.col("outer_high").alias("high"), F.col("outer_low").alias("low"), F.transform(places, lambda x: x + F.col("first")).alias("places"))
    return moved.groupBy("high", "low").agg(F.sort_array(F.flatten(F.collect_list("places"))).alias("repeated"))


def _by_windows(strings: DataFrame, window: int, m: int, bucket_strings: int, level: int) -> DataFrame:
    """Repeated windows of the strings of crowded buckets, window by window."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows, spots, digests = [], [], []
                for i, packed in enumerate(part.column("packed").to_pylist()):
                    words = packed.split(b" ")
                    for k in range(len(words) - window + 1):
                        rows.append(i)
                        spots.append(k)
                        digests.append(xxhash.xxh128_digest(b" ".join(words[k : k + window])))
                taken = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(name).take(taken) for name in ("high", "low", "often")), pa.array(spots, pa.int32()), pa.array(digests, pa.binary())],
                    ["high", "low", "often", "spot", "digest"],
                )

    dealt = strings.select("high", "low", "often", "packed")
    dealt = dealt.mapInArrow(windows, "high bigint, low bigint, often bigint, spot int, digest binary")
    met = dealt.groupBy("digest").agg(F.sum("often").alias("total")).filter("total > 1").select("digest")
    return dealt.join(met, "digest").groupBy("high", "low").agg(F.sort_array(F.collect_list("spot")).alias("repeated"))


def dedup(docs: DataFrame, *, window: int, m: int = RUN_WORDS, bucket_strings: int = BUCKET_STRINGS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words, n_removed, kept``: every text without the words of its repeated windows.

    A window is repeated if its words also start anywhere else, in any text or the
    same one; all its occurrences go. Windows are judged on the given texts. Words
    are runs of anything but space and the characters 9 to 13, and are compared
    as they are; ``kept`` is joined by one space. A NULL or empty text has no
    words, a text shorter than a window keeps all. Every row is a text of its own,
    so the windows of a row given twice are repeated; the result has a row for
    each. NULL ids are ids like any other. Other columns are not looked at.
    """
    m = min(m, window)
    named = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # With the id, a digest of the text names a row; equal rows get equal results.
    named = named.withColumn("sum", F.xxhash64("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_use()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [packed_runs(word_hashes(words_of(text.as_py())), window, m) for text in part.column("text")]
                rows = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
                columns = [pa.array(np.concatenate(c).astype(k)) for c, k in zip(zip(*found), (np.int32, np.int32, np.int64))]
                yield pa.RecordBatch.from_arrays([part.column("id").take(rows), part.column("sum").take(rows), *columns], ["id", "sum", "start", "n", "least"])

    places = kept(named.mapInArrow(cut, "id bigint, sum bigint, start int, n int, least bigint"), "places")
    again = places.groupBy("least").count().filter("count > 1").select("least")
    wanted = places.join(again, "least").groupBy("id", "sum").agg(F.collect_set(F.struct("start", "n", "least")).alias("places"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                rows, starts, sizes, leasts, highs, lows, strings = [], [], [], [], [], [], []
                for i, (text, spots) in enumerate(zip(part.column("text").to_pylist(), part.column("places").to_pylist())):
                    words = words_of(text)
                    for spot in spots:
                        packed = b" ".join(words[spot["start"] : spot["start"] + spot["n"] + window - 1])
                        high, low = _key(packed)
                        rows.append(i)
                        starts.append(spot["start"])
                        sizes.append(spot["n"])
                        leasts.append(spot["least"])
                        highs.append(high)
                        lows.append(low)
                        strings.append(packed)
                taken = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(taken),
                        part.column("sum").take(taken),
                        pa.array(starts, pa.int32()),
                        pa.array(sizes, pa.int32()),
                        pa.array(leasts, pa.int64()),
                        pa.array(highs, pa.int64()),
                        pa.array(lows, pa.int64()),
                        pa.array(strings, pa.binary()),
                    ],
                    ["id", "sum", "start", "n", "least", "high", "low", "packed"],
                )

    same_row = F.col("d.id").eqNullSafe(F.col("w.id")) & (F.col("d.sum") == F.col("w.sum"))
    joined = named.alias("d").join(wanted.alias("w"), same_row).select("d.id", "d.sum", "d.text", "w.places")
    packed = kept(
        joined.mapInArrow(pack, "id bigint, sum bigint, start int, n int, least bigint, high bigint, low bigint, packed binary"), "packed"
    )
    verdicts = _verdicts(packed.withColumn("often", F.lit(1)), window, m, bucket_strings)
    judged = packed.select("id", "sum", "start", "n", "high", "low").join(verdicts, ["high", "low"])
    spans = judged.groupBy("id", "sum").agg(F.collect_set(F.struct("start", "n", "repeated")).alias("spans"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                totals, gone, texts = [], [], []
                for text, found in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                    words = words_of(text)
                    if not found:
                        totals.append(len(words))
                        gone.append(0)
                        texts.append(b" ".join(words).decode("utf-8"))
                        continue
                    change = np.zeros(len(words) + 1, np.int64)
                    for span in found:
                        if span["repeated"] is None:
                            first, last = [span["start"]], [span["start"] + span["n"] + window - 1]
                            change[first] += 1
                            change[last] -= 1
                        else:
                            begins = np.asarray(span["repeated"]) + span["start"]
                            np.add.at(change, begins, 1)
                            np.add.at(change, begins + window, -1)
                    covered = np.cumsum(change[:-1]) > 0
                    totals.append(len(words))
                    gone.append(int(covered.sum()))
                    left = words if not gone[-1] else [word for word, out in zip(words, covered) if not out]
                    texts.append(b" ".join(left).decode("utf-8"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())],
                    ["id", "n_words", "n_removed", "kept"],
                )

    same = F.col("d.id").eqNullSafe(F.col("s.id")) & (F.col("d.sum") == F.col("s.sum"))
    whole = named.alias("d").join(spans.alias("s"), same, "left").select("d.id", "d.text", "s.spans")
    return whole.mapInArrow(remove, "id bigint, n_words bigint, n_removed bigint, kept string").withColumnRenamed("id", id_col)
