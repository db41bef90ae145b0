"""Terms of documents, vocabulary bounds, frequencies and co-occurrence.

Documents enter as one row per distinct text with ``copies``, the number of
documents that share it, so equal texts are tokenised and paired only once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.text import ngrams, tokens, without_words
from driftline.operators.joins import fits_broadcast, lookup_join
from driftline.session import shuffle_width


# Terms of a block of a long list; two blocks are a unit of work.
BLOCK_TERMS = 256


def distinct_texts(docs: DataFrame, text: str) -> DataFrame:
    """Each different text once, with its number of ``copies``."""
    return docs.groupBy(F.col(text).alias("text")).agg(F.count(F.lit(1)).alias("copies"))


def clean_tokens(text: Column, stop_words=()) -> Column:
    return without_words(tokens(text), stop_words)


def doc_terms(
    docs: DataFrame,
    key: list[str],
    *,
    stop_words=(),
    lowest: int = 1,
    highest: int = 3,
    within: DataFrame | None = None,
) -> DataFrame:
    """``key..., term, tf``: how often each n-gram occurs in each document.

    ``docs`` has the key columns and ``text``; ``key[0]`` identifies a document.
    Texts are shuffled once, before they are cut into terms, by the document key:
    the count per document then needs no shuffle of the far larger term table.
    Of a vocabulary in ``within`` only the terms are kept, with its other columns.
    A small one is looked up before the count, a large one after it, where there
    are fewer rows to shuffle.
    """
    placed = docs.repartition(shuffle_width(docs.sparkSession), key[0])
    words = placed.select(*key, clean_tokens(F.col("text"), stop_words).alias("words"))
    grams = words.select(*key, F.explode(ngrams(F.col("words"), lowest, highest)).alias("term"))
    count = F.count(F.lit(1)).alias("tf")
    if within is None:
        return grams.groupBy(*key, "term").agg(count)
    if fits_broadcast(within):
        extra = [name for name in within.columns if name != "term"]
        return lookup_join(grams, within, "term", "inner", small=True).groupBy(*key, "term", *extra).agg(count)
    return lookup_join(grams.groupBy(*key, "term").agg(count), within, "term", "inner", small=False)


def text_terms(texts: DataFrame, **options) -> DataFrame:
    """``doc_terms`` of distinct texts, keyed by the text itself, so meant for short ones."""
    return doc_terms(texts.select("text", "copies"), ["text", "copies"], **options)


def vocabulary(
    docs: DataFrame,
    n_docs: Column,
    *,
    stop_words=(),
    lowest: int = 1,
    highest: int = 3,
    min_df: float = 1,
    max_df: float = 1.0,
) -> DataFrame:
    """``term, df, frequency`` of the n-grams whose document frequency is within both bounds.

    A whole-number bound counts documents; a fractional one is multiplied by the
    number of documents and not rounded. ``docs`` has one row per document with
    ``text``, weighed by ``copies`` where present. Each row gives all its n-grams
    and, marked apart, its different ones, so a single combinable sum by term
    yields both counts and texts are not shuffled.
    """
    copies = F.col("copies") if "copies" in docs.columns else F.lit(1)

    def bound(limit):
        return F.lit(limit) if isinstance(limit, int) else F.lit(float(limit)) * n_docs

    words = docs.select(copies.cast("long").alias("copies"), clean_tokens(F.col("text"), stop_words).alias("words"))
    grams = words.select("copies", ngrams(F.col("words"), lowest, highest).alias("grams"))
    both = F.array(
        F.struct(F.col("grams").alias("terms"), F.lit(False).alias("once")),
        F.struct(F.array_distinct("grams").alias("terms"), F.lit(True).alias("once")),
    )
    lists = grams.select("copies", F.explode(both).alias("list"))
    return (
        lists.select("copies", F.col("list.once").alias("once"), F.explode("list.terms").alias("term"))
        .groupBy("term")
        .agg(
            F.sum(F.when(F.col("once"), F.col("copies")).otherwise(0)).alias("df"),
            F.sum(F.when(F.col("once"), 0).otherwise(F.col("copies"))).alias("frequency"),
        )
        .filter((F.col("df") >= bound(min_df)) & (F.col("df") <= bound(max_df)))
    )


def word_frequency(vocab: DataFrame) -> DataFrame:
    return vocab.select(F.col("term").alias("word"), "frequency").orderBy(F.desc("frequency"), "word")


def top_tokens(vocab: DataFrame, n: int = 25) -> DataFrame:
    return word_frequency(vocab).limit(n)


def pair_units(lists: DataFrame, block: int) -> DataFrame:
    """``n, left, right, same``: sorted term lists as pairs of blocks, of which each gives at most ``block ** 2`` pairs of terms.

    A list of up to ``block`` terms is one unit and stays where it is. The units of
    longer ones, two blocks each, are dealt out evenly, so one long text is shared
    by many tasks.
    """
    short = lists.filter(F.size("terms") <= block).select("n", F.col("terms").alias("left"), F.col("terms").alias("right"), F.lit(True).alias("same"))
    starts = F.sequence(F.lit(1), F.size("terms"), F.lit(block))
    long = lists.filter(F.size("terms") > block).select("n", F.transform(starts, lambda at: F.slice("terms", at, F.lit(block))).alias("blocks"))
    placed = long.select("n", "blocks", F.posexplode("blocks").alias("i", "left"))
    units = placed.select("n", "left", F.posexplode(F.slice("blocks", F.col("i") + 1, F.size("blocks") - F.col("i"))).alias("k", "right"))
    dealt = units.repartition(shuffle_width(lists.sparkSession))
    return short.unionByName(dealt.select("n", "left", "right", (F.col("k") == 0).alias("same")))


def cooccurrence(terms: DataFrame, *, block: int = BLOCK_TERMS) -> DataFrame:
    """``a, b, weight`` in both directions: the product of term counts summed over documents.

    Documents with the same term counts are merged first. Each remaining term
    list gives its pairs block by block, with no self-join, and the sums are
    combined before the one shuffle by pair.
    """
    key = [name for name in terms.columns if name not in ("term", "tf")]
    copies = F.first("copies") if "copies" in terms.columns else F.lit(1)
    lists = (
        terms.groupBy(*key)
        .agg(F.sort_array(F.collect_list(F.struct("term", "tf"))).alias("terms"), copies.cast("long").alias("n"))
        .groupBy("terms")
        .agg(F.sum("n").alias("n"))
    )
    firsts = pair_units(lists, block).select("n", "right", "same", F.posexplode("left").alias("at", "a"))
    # Within a block each term meets the later ones, in another one all.
    met = F.when(F.col("same"), F.slice("right", F.col("at") + 2, F.greatest(F.size("right") - F.col("at") - 1, F.lit(0)))).otherwise(F.col("right"))
    pairs = firsts.select("a", "n", F.explode(met).alias("b"))
    once = pairs.groupBy(F.col("a.term").alias("a"), F.col("b.term").alias("b")).agg(
        F.sum(F.col("a.tf") * F.col("b.tf") * F.col("n")).alias("weight")
    )
    ends = F.array(
        F.struct(F.col("a"), F.col("b")),
        F.struct(F.col("b").alias("a"), F.col("a").alias("b")),
    )
    return once.select(F.explode(ends).alias("ends"), "weight").select("ends.a", "ends.b", "weight")


def word_graph(vocab: DataFrame, pairs: DataFrame) -> DataFrame:
    """All vocabulary terms with their neighbours; a term without any has one row with NULLs."""
    nodes = vocab.select(F.col("term").alias("a"))
    return nodes.join(pairs, "a", "left")
