"""Quality of texts: plain rules, and the likelihood of their n-grams under trusted and raw texts.

Column expressions and joins only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
# Mean log-likelihood ratio per n-gram below which a text is dropped.
MIN_SCORE = -0.04
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def repeated_words(keys: Column, size: Column) -> Column:
    """Words covered by windows whose key occurs twice or more among ``keys``, the keys of all windows in order.

    Keys are sorted with their places, so equal ones stand side by side; the places
    of those, sorted again, cover three words each, less what the next one covers.
    """
    placed = F.array_sort(F.transform(keys, lambda key, i: F.struct(key.alias("key"), i.alias("at"))))

    def with_sorted(pairs: Column) -> Column:
        equal = F.filter(
            pairs,
            lambda pair, i: (pair["key"] == F.get(pairs, i + 1)["key"]) | (F.when(i > 0, pair["key"] == F.get(pairs, i - 1)["key"]).otherwise(False)),
        )
        places = F.array_sort(F.transform(equal, lambda pair: pair["at"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("covered"))
        return F.aggregate(
            places,
            start,
            lambda state, at: F.struct(at.alias("last"), (state["covered"] + F.least(F.lit(3), at - state["last"])).alias("covered")),
            lambda state: state["covered"],
        )

    # An array of one binds the sorted pairs, so they are not sorted again for each of them.
    counted = F.get(F.transform(F.array(placed), with_sorted), F.lit(0))
    return F.when(F.size(F.array_distinct(keys)) < size - 2, counted).otherwise(0)


def base_features(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``hashes`` of the words, and the counts the plain rules look at."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    cut = docs.select(F.col(id_col), text_of(docs, text_col)).withColumn("words", words_of(F.col("text")))
    counted = cut.select(
        id_col,
        hashes_of(F.col("words")).alias("hashes"),
        F.size("words").alias("n_words"),
        F.length(F.concat_ws("", "words")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    windows = F.transform(
        F.slice("hashes", F.lit(1), F.greatest(F.col("n_words") - 2, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get("hashes", i + 1), F.get("hashes", i + 2)),
    )
    keyed = counted.withColumn("keys", windows)
    return keyed.select(
        id_col,
        "hashes",
        F.col("n_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("keys"), F.col("n_words")).cast("long").alias("n_repeat_words"),
    )


def text_of(docs: DataFrame, text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit("")).alias("text")


def buckets_of(hashes: str, buckets: int) -> Column:
    """Buckets of all words and pairs of neighbouring words."""
    single = F.transform(F.col(hashes), lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    pairs = F.transform(
        F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 1, F.lit(0))),
        lambda h, i: F.pmod(F.xxhash64(h, F.get(hashes, i + 1)), F.lit(buckets)).cast("int"),
    )
    return F.concat(single, pairs)


def bucket_counts(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket, raw, target``: n-grams of all texts, and of those whose id is in ``trusted``.

    Counts are summed before they are shuffled, so a bucket of any size is one row per task.
    """
    marked = trusted.select(F.col(id_col)).distinct().withColumn("is_target", F.lit(1))
    # One plan at any size: the list of trusted ids is as long as the caller's table, so it is never sent whole.
    joined = docs.select(id_col, text_of(docs, text_col)).join(marked.hint("merge"), id_col, "left")
    hashed = joined.select(hashes_of(words_of(F.col("text"))).alias("hashes"), F.coalesce("is_target", F.lit(0)).alias("is_target"))
    grams = hashed.select("is_target", F.explode(buckets_of("hashes", buckets)).alias("bucket"))
    return grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("is_target").alias("target"))


def log_ratios(counts: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """Per bucket the log of its share in the target over that in all texts, each with one added.

    The table has ``buckets`` rows at any size of the corpus. Without a target all are 0.
    """
    rows = {row["bucket"]: row for row in counts.collect()}
    raw, target = (sum(row[name] for row in rows.values()) for name in ("raw", "target"))
    if not target:
        return [0.0] * buckets

    def ratio(bucket: int) -> float:
        row = rows.get(bucket)
        return math.log(((row["target"] if row else 0) + 1) / (target + buckets)) - math.log(((row["raw"] if row else 0) + 1) / (raw + buckets))

    return [ratio(bucket) for bucket in range(buckets)]


def judge(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, min_score: float = MIN_SCORE) -> DataFrame:
    """``id``, the plain counts, ``base_failed``, ``score`` and ``kept`` of every text.

    ``score`` is the mean over a text's words and word pairs of the log ratio of
    their buckets, 0 without words. A text is kept if no plain rule fails and its
    score is ``min_score`` or more; the same corpus always gives the same verdicts.
    NULL and empty texts have no words and fail. Rows are judged each for itself.
    """
    ratios = log_ratios(bucket_counts(docs, trusted, id_col=id_col, text_col=text_col, buckets=buckets), buckets)
    # One constant, folded into an array when the plan is made.
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    features = base_features(docs, id_col=id_col, text_col=text_col).withColumn("grams", buckets_of("hashes", buckets))
    total = F.aggregate("grams", F.lit(0.0), lambda so_far, bucket: so_far + F.get(table, bucket))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = features.withColumn("score", F.round(F.when(F.size("grams") > 0, total / F.size("grams")).otherwise(0.0), 9))
    judged = F.struct(
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("score") >= min_score)).alias("kept"),
        "score",
    )
    # A filter on the verdict stays above the generator; below it, everything it rests on would be worked again for each word.
    return scored.select(id_col, F.inline(F.array(judged)))
