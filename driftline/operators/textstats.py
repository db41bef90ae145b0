"""Length and readability measures of message texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.text import letter_count, sentence_count, word_count


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, or NULL where there is nothing to divide by."""
    return F.when(whole > 0, part / whole)


def text_lengths(messages: DataFrame) -> DataFrame:
    """Words, characters, sentences and letters of each message that has a text; ids are unique within a channel."""
    text = F.col("text")
    return messages.filter(text.isNotNull()).select(
        "channel_username",
        "message_id",
        word_count(text).alias("word_count"),
        F.length(text).alias("char_count"),
        sentence_count(text).alias("sentence_count"),
        letter_count(text).alias("letter_count"),
    )


def sentence_length(lengths: DataFrame) -> DataFrame:
    return lengths.select(
        "channel_username",
        "message_id",
        "word_count",
        "sentence_count",
        ratio(F.col("word_count"), F.col("sentence_count")).alias("words_per_sentence"),
    )


def letters_per_word(lengths: DataFrame) -> DataFrame:
    return lengths.select(
        "channel_username",
        "message_id",
        "word_count",
        "letter_count",
        ratio(F.col("letter_count"), F.col("word_count")).alias("letters_per_word"),
    )


def gulpease(lengths: DataFrame) -> DataFrame:
    """Gulpease index: 89 + (300 * sentences - 10 * letters) / words."""
    score = 89 + ratio(300 * F.col("sentence_count") - 10 * F.col("letter_count"), F.col("word_count"))
    return lengths.select("channel_username", "message_id", score.alias("gulpease"))
