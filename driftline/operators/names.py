"""Channel names: table, lengths, histogram, Zipf fit and summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.clean import strip
from driftline.functions.text import word_count
from driftline.operators.ranking import global_rank
from driftline.schemas import require_columns
from driftline.session import stage

# Italian articles and simple prepositions.
ARTICLES_AND_PREPOSITIONS = (
    "il", "lo", "la", "i", "gli", "le", "un", "uno", "una",
    "di", "a", "da", "in", "con", "su", "per", "tra", "fra",
)


def name_table(channels: DataFrame) -> DataFrame:
    """One row per channel row with a title; repeated channels stay."""
    require_columns(channels, ["username", "title"])
    return channels.filter(F.col("title").isNotNull() & (strip(F.col("title")) != "")).select(
        "channel_id", F.col("title").alias("name"), "source_file", F.lit("title").alias("name_kind")
    )


def name_features(names: DataFrame, *, function_words=ARTICLES_AND_PREPOSITIONS) -> DataFrame:
    """Word and character count of each name, and whether it has an article or preposition."""
    marked = F.exists(F.split(F.lower("name"), r"[^\p{L}\p{N}_]+"), lambda word: word.isin(list(function_words)))
    return names.select(
        "*",
        word_count(F.col("name")).alias("word_count"),
        F.length("name").alias("char_count"),
        marked.alias("has_article_or_preposition"),
    )


def length_stats(features: DataFrame) -> DataFrame:
    """``metric, value`` rows."""
    share = F.avg(F.col("has_article_or_preposition").cast("double"))
    wide = features.agg(
        F.avg("word_count").alias("avg_words_per_name"),
        F.avg("char_count").alias("avg_chars_per_name"),
        share.alias("pct_names_with_article_or_preposition"),
    )
    return wide.unpivot([], wide.columns, "metric", "value")


def length_histogram(features: DataFrame, columns=("word_count", "char_count"), *, bins: int = 20) -> DataFrame:
    """``metric, bin, lower, upper, n``: equal-width bins of each column from its least to its greatest value.

    The last bin includes its upper edge. If all values are equal, the range is
    widened by a half on both sides.
    """
    pairs = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("v")) for name in columns])
    values = features.select(F.inline(pairs))
    spread = values.groupBy("metric").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    edges = stage(
        spread.select(
            "metric",
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    )
    place = F.least(F.floor(F.lit(bins) * (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))) + 1, F.lit(bins))
    # One row of edges per column.
    counts = (
        values.join(F.broadcast(edges), "metric")
        .groupBy("metric", place.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    return (
        edges.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
        .join(counts, ["metric", "bin"], "left")
        .select(
            "metric",
            "bin",
            (F.col("lo") + (F.col("bin") - 1) * width).alias("lower"),
            (F.col("lo") + F.col("bin") * width).alias("upper"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def zipf_table(frequencies: DataFrame) -> DataFrame:
    """Rank of each word by frequency (ties by word), with both logarithms."""
    ranked = global_rank(frequencies.select("word", "frequency"), [F.desc("frequency"), F.asc("word")])
    return ranked.select(
        "word",
        "frequency",
        "rank",
        F.log("rank").alias("log_rank"),
        F.log("frequency").alias("log_frequency"),
    )


def zipf_fit(zipf: DataFrame) -> DataFrame:
    """Straight line through the log-log points."""
    return zipf.agg(
        F.regr_slope("log_frequency", "log_rank").alias("slope"),
        F.regr_intercept("log_frequency", "log_rank").alias("intercept"),
    )


def name_summary(channels: DataFrame, features: DataFrame, fit: DataFrame) -> DataFrame:
    """One row of totals, with the Zipf line nested under ``zipf``."""
    share = F.avg(F.col("has_article_or_preposition").cast("double"))
    zero = F.lit(0.0)
    return features.agg(
        F.count(F.lit(1)).alias("names_analyzed"),
        F.coalesce(F.avg("word_count"), zero).alias("avg_words_per_name"),
        F.coalesce(F.avg("char_count"), zero).alias("avg_chars_per_name"),
        F.coalesce(share, zero).alias("pct_names_with_article_or_preposition"),
    ).select(
        F.current_timestamp().alias("generated_at_utc"),
        channels.agg(F.count(F.lit(1))).scalar().alias("merged_csv_rows"),
        "*",
        F.struct(
            fit.select("slope").scalar().alias("slope"), fit.select("intercept").scalar().alias("intercept")
        ).alias("zipf"),
    )
