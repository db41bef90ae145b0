"""Selection, filtering, de-duplication and totals of channel messages."""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.clean import channel_name, forward_source, strip
from driftline.operators.joins import lookup_join
from driftline.operators.ranking import top_n_per_key, top_n_wide
from driftline.schemas import FORWARD_HEADER, MESSAGES, require_columns
from driftline.session import stage

# Sent along with the tasks, so workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEFAULT_LIMIT = 100
# White space between words, the same to Python and Arrow.
SPACE = r"[ \t\n\r\f\v]"


def newest_first() -> list[Column]:
    return [F.desc_nulls_last("date"), F.desc("message_id")]


def channel_list(channels: DataFrame, column: str = "username") -> DataFrame:
    """Distinct bare channel names found in one column of a channel table; cells that leave no name are passed over."""
    require_columns(channels, [column])
    named = channels.select(channel_name(F.col(column).cast("string")).alias("channel_username"))
    return named.filter(F.col("channel_username") != "").distinct()


def pending_channels(channels: DataFrame, processed: DataFrame) -> DataFrame:
    """Channels that have no entry in the trace of processed channels."""
    done = processed.select(channel_name(F.col("channel_username")).alias("channel_username")).distinct()
    return channels.join(done, "channel_username", "left_anti")


def in_date_range(column: str, start=None, end=None, kind: str = "timestamp") -> Column:
    """Both ends inclusive; an end that is None is open."""
    keep = F.lit(True)
    if start is not None:
        keep = keep & (F.col(column) >= F.lit(start).cast(kind))
    if end is not None:
        keep = keep & (F.col(column) <= F.lit(end).cast(kind))
    return keep


def messages_in_range(messages: DataFrame, start=None, end=None, *, column: str = "date") -> DataFrame:
    """Messages within the dates.

    The bounds take the type of the stored column, so that the comparison
    reaches the file scan.
    """
    return messages.filter(in_date_range(column, start, end, messages.schema[column].dataType.simpleString()))


# From so many keywords on, they are looked for in each different word once.
MANY_KEYWORDS = 64
# Words whose keywords a task remembers; it begins anew beyond.
KNOWN_WORDS = 500_000
# Cells of the table of texts and keywords that are marked at a time, and words whose keywords are.
CELLS = 1 << 24
WORDS_AT_A_TIME = 1 << 16


def _runs(text: str, lengths=(3,)) -> set[str]:
    """Different runs of so many characters."""
    return {text[i : i + n] for n in lengths for i in range(len(text) - n + 1)}


def keyword_keys(posts: DataFrame, words: DataFrame) -> DataFrame:
    """``words`` with ``key``, the trigram of each keyword that fewest texts hold, the first of equals by its letters.

    ``posts`` has ``_text`` and ``words`` has ``word``, both in lower case. Texts
    are read once, each along its length, and only trigrams of keywords are counted.
    """

    @F.arrow_udf("array<string>")
    def trigrams(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(_runs(text)) for text in texts.to_pylist()], pa.list_(pa.string()))

    of_words = stage(words.select("*", F.explode(trigrams(F.col("word"))).alias("key")))
    # The caller's list.
    wanted = {row.key for row in of_words.select("key").distinct().collect()}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter()
            for text in batch.column("_text"):
                found.update(_runs(text.as_py()) & wanted)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["key", "n"])

    counts = posts.select("_text").mapInArrow(held, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    order = F.struct(F.coalesce("n", F.lit(0)), "key")
    return of_words.join(counts, "key", "left").groupBy(*words.columns).agg(F.min(order).alias("least")).select(*words.columns, "least.key")


class KeywordFinder:
    """Numbers of the lower-case keywords in lower-case texts, by the different words of a batch.

    A keyword without white space lies within one word, and words come again and
    again; within a word, only keywords are tried whose rarest trigram it holds, or
    which have less than three letters. Keywords with white space are looked for in
    the whole text. ``keywords`` has number, word and rarest trigram, if any.
    """

    def __init__(self, keywords: list[tuple[int, str, str | None]]) -> None:
        self.width = max((number for number, _, _ in keywords), default=-1) + 1
        self.everywhere = [number for number, word, _ in keywords if not word]
        self.across = [(number, word) for number, word, _ in keywords if re.search(SPACE, word)]
        self.by_key: dict[str, list[tuple[int, str]]] = {}
        for number, word, key in keywords:
            if word and not re.search(SPACE, word):
                self.by_key.setdefault(key or word, []).append((number, word))
        self.known: dict[str, list[int]] = {}

    def of_word(self, word: str) -> list[int]:
        found = self.known.get(word)
        if found is None:
            found = sorted({number for run in _runs(word, (1, 2, 3)) for number, keyword in self.by_key.get(run, ()) if keyword in word})
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def __call__(self, texts: pa.Array) -> pa.Array:
        words = pc.split_pattern_regex(texts, f"{SPACE}+")
        coded = words.flatten().dictionary_encode()
        of_words = [self.of_word(word) for word in coded.dictionary.to_pylist()]
        sizes = np.array([len(found) for found in of_words], np.int64)
        begins, flat = np.cumsum(sizes) - sizes, np.array([number for found in of_words for number in found], np.int64)
        ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.repeat(np.arange(len(texts)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
        # Each word of a text once, of those that hold any keyword.
        held = sizes[ids] > 0
        pairs = np.unique(text[held] * max(1, len(sizes)) + ids[held])
        text, ids = np.divmod(pairs, max(1, len(sizes)))
        counts, hits = np.zeros(len(texts), np.int64), []
        step = max(1, CELLS // max(1, self.width))
        for first in range(0, len(texts), step):
            # Keywords come again in many words of a text: they are marked, not listed per word.
            part = texts.slice(first, step)
            marks = np.zeros((len(part), self.width), bool)
            marks[:, self.everywhere] = True
            for number, word in self.across:
                marks[:, number] |= pc.match_substring(part, word).to_numpy(zero_copy_only=False)
            at, end = np.searchsorted(text, (first, first + step))
            for i in range(at, end, WORDS_AT_A_TIME):
                on, row = ids[i : min(end, i + WORDS_AT_A_TIME)], text[i : min(end, i + WORDS_AT_A_TIME)] - first
                n = sizes[on]
                places = np.repeat(begins[on] - np.cumsum(n) + n, n) + np.arange(n.sum())
                marks[np.repeat(row, n), flat[places]] = True
            row, number = np.nonzero(marks)
            counts[first : first + step] = np.bincount(row, minlength=len(part))
            hits.append(number.astype(np.int32))
        offsets = np.concatenate([[0], np.cumsum(counts)])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([*hits, np.empty(0, np.int32)]), pa.int32()))


def match_keywords(posts: DataFrame, keywords=("",), *, many: int = MANY_KEYWORDS) -> DataFrame:
    """One row per post and keyword in its text, regardless of case; '' matches every post.

    Each post is read where it lies, without a shuffle. A few keywords are literals of the
    plan. ``many`` or more are looked for in each different word of a batch of
    posts, by the rarest trigram of each.
    """
    text = F.lower(F.coalesce("text", F.lit("")))
    numbered = list(enumerate(keywords))
    names = [*posts.columns, "_hit.keyword_no", "_hit.keyword"]
    if len(numbered) < many:
        hits = [
            F.when(F.contains("_text", F.lower(F.lit(word))), F.struct(F.lit(number).alias("keyword_no"), F.lit(word).alias("keyword")))
            for number, word in numbered
        ]
        lowered = posts.withColumn("_text", text)
        return lowered.withColumn("_hit", F.explode(F.array_compact(F.array(*hits)))).select(*names)
    spark = posts.sparkSession
    words = spark.createDataFrame(numbered, "keyword_no int, keyword string").select("keyword_no", F.lower("keyword").alias("word"))
    keyed = keyword_keys(posts.select(text.alias("_text")), words.filter(F.length("word") > 2))
    short = words.filter(F.length("word") <= 2).withColumn("key", F.lit(None).cast("string"))
    finder = KeywordFinder([tuple(row) for row in keyed.unionByName(short).collect()])

    @F.arrow_udf("array<int>")
    def found(texts: pa.Array) -> pa.Array:
        return finder(texts)

    listed = F.array(*[F.lit(word) for _, word in numbered])
    hit = F.struct(F.col("_no").alias("keyword_no"), F.get(listed, F.col("_no")).alias("keyword"))
    return posts.withColumn("_no", F.explode(found(text))).withColumn("_hit", hit).select(*names)


def keyword_posts(posts: DataFrame, keywords=("",), limit: int | None = DEFAULT_LIMIT) -> DataFrame:
    """The newest ``limit`` posts of each channel for each keyword."""
    matched = match_keywords(posts, keywords)
    if limit is None:
        return matched
    return top_n_wide(matched, ["channel_username", "keyword_no"], [F.col("date"), F.col("message_id")], limit)


def latest_posts(posts: DataFrame, limit: int = DEFAULT_LIMIT, *, channel: str = "channel_id") -> DataFrame:
    """The newest ``limit`` posts of each channel."""
    return top_n_per_key(posts, [channel], newest_first(), limit)


def with_forward_origin(posts: DataFrame) -> DataFrame:
    """Replace a ``fwd_from`` header by ``is_forwarded`` and ``forward_from_chat``."""
    if "fwd_from" not in posts.columns:
        return posts
    header = F.col("fwd_from").cast(FORWARD_HEADER)
    return (
        posts.withColumn("is_forwarded", F.col("fwd_from").isNotNull())
        .withColumn("forward_from_chat", forward_source(header))
        .drop("fwd_from")
    )


def message_record(posts: DataFrame) -> DataFrame:
    """Posts in the columns and types of the message table, counts never NULL."""
    return with_forward_origin(posts).select(
        F.col("message_id").cast("long").alias("message_id"),
        "channel_username",
        "date",
        "text",
        F.coalesce(F.col("views").cast("long"), F.lit(0)).alias("views"),
        F.coalesce(F.col("forwards").cast("long"), F.lit(0)).alias("forwards"),
        F.coalesce("is_forwarded", F.lit(False)).alias("is_forwarded"),
        "forward_from_chat",
    )


def last_write_per_message(posts: DataFrame) -> DataFrame:
    """One row per (channel, message); the last keyword, and in it the last post read, wins."""
    kept = [name for name in MESSAGES.names if name not in ("channel_username", "message_id")]
    return (
        posts.groupBy("channel_username", "message_id")
        .agg(F.max_by(F.struct(*kept), F.struct("keyword_no", "rank")).alias("record"))
        .select("message_id", "channel_username", *[f"record.{name}" for name in kept])
    )


def collect_messages(
    posts: DataFrame,
    channels: DataFrame | None = None,
    *,
    keywords=("",),
    start=None,
    end=None,
    limit: int | None = DEFAULT_LIMIT,
) -> DataFrame:
    """The message table of one collection run.

    Per channel and keyword the newest ``limit`` posts are read; those without
    text or outside the dates are then dropped, so they count against the limit.
    """
    if channels is not None:
        posts = lookup_join(posts, channels.select("channel_username"), "channel_username", "left_semi")
    read = keyword_posts(with_forward_origin(posts), keywords, limit)
    if limit is None:
        read = read.withColumn("rank", F.struct(-F.unix_micros("date"), -F.col("message_id")))
    wanted = read.filter((F.coalesce("text", F.lit("")) != "") & in_date_range("date", start, end))
    return message_record(last_write_per_message(wanted))


def channel_trace(records: DataFrame) -> DataFrame:
    """Messages written per channel; a channel without any has no row."""
    return records.groupBy("channel_username").agg(F.count(F.lit(1)).alias("messages_written"))


def messages_per_channel(records: DataFrame) -> DataFrame:
    return records.groupBy("channel_username").agg(F.count(F.lit(1)).alias("messages")).orderBy("channel_username")


def collection_totals(records: DataFrame) -> DataFrame:
    return records.agg(
        F.count(F.lit(1)).alias("messages"),
        F.countDistinct("channel_username").alias("channels"),
        F.coalesce(F.sum("views"), F.lit(0)).alias("total_views"),
    )


def top_forward_sources(records: DataFrame, n: int = 3) -> DataFrame:
    return (
        records.filter(strip(F.col("forward_from_chat")) != "")
        .groupBy("forward_from_chat")
        .agg(F.count(F.lit(1)).alias("messages"))
        .orderBy(F.desc("messages"), "forward_from_chat")
        .limit(n)
    )
