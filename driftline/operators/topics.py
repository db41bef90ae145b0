"""Topic corpus, document keywords, topic factorisation and topics over time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.clean import strip, without_urls
from driftline.operators import cosines, grams, pairs
from driftline.operators.joins import fits_broadcast, lookup_join
from driftline.operators.ranking import top_n_per_key
from driftline.operators.vocabulary import clean_tokens, doc_terms
from driftline.session import pieces, shuffle_width, stage

# Settings of the topic model.
TOPICS = 5
KEYWORDS = 5
MIN_DF = 5
SIZES = {"lowest": 1, "highest": 3}
BINS = 10
SEED = 42

# The factorisation ends when a round gains no more than this share, at the latest after so many rounds.
TOLERANCE = 1e-3
ROUNDS = 60
LOOK_EVERY = 5

EPSILON = 1e-12

# Documents that a task cuts into words for the model of word counts.
TASK_DOCS = 10_000

# Terms of a vocabulary that is sent to all tasks as hashes, 256 MB at most.
SENT_TERMS = 1 << 25


def topic_corpus(messages: DataFrame) -> DataFrame:
    """``doc_id, channel_username, message_id, date, text``: the first message of each text, dated, not blank, without web addresses.

    A document is a distinct text, and the digest of the text is its id: message
    ids say nothing outside their channel. The first message is picked by its
    numbers and names alone, a combinable minimum, so a text with any number of
    copies is never gathered in one place. The date is looked at after the copies
    are merged, as the first copy decides.
    """
    keyed = messages.filter(F.col("text").isNotNull()).withColumn("doc_id", F.sha2("text", 256))
    first = F.min(F.struct("message_id", "channel_username", "date", "text")).alias("first")
    return (
        keyed.groupBy("doc_id")
        .agg(first)
        .filter(F.col("first.date").isNotNull() & (strip(F.col("first.text")) != ""))
        .select(
            "doc_id",
            F.col("first.channel_username").alias("channel_username"),
            F.col("first.message_id").alias("message_id"),
            F.col("first.date").alias("date"),
            without_urls(F.col("first.text")).alias("text"),
        )
    )


def top_terms_per_doc(weighted: DataFrame, n: int = KEYWORDS) -> DataFrame:
    """The ``n`` heaviest terms of each document; a document is one bounded group."""
    best = Window.partitionBy("doc_id").orderBy(F.desc("weight"), "term")
    return weighted.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def _word_blocks(corpus: DataFrame, kept: list[str], stop_words) -> tuple[DataFrame, int, int]:
    """The words of the texts in blocks of documents, the number of documents and a bound on that of words."""
    n_docs, letters = corpus.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    # A token has two letters and something between it and the next.
    return grams.in_blocks(corpus.select(*kept, "text"), clean_tokens(F.col("text"), stop_words)), n_docs, (letters or 0) // 3 + n_docs


def corpus_vocabulary(corpus: DataFrame, *, stop_words=(), min_df: float = MIN_DF, max_df: float = 1.0) -> DataFrame:
    """Staged ``term, df, frequency`` of the corpus, which is read twice, so pass it staged.

    A whole-number bound counts documents; a fractional one is multiplied by the number of documents.
    """
    blocks, n_docs, tokens = _word_blocks(corpus, [], stop_words)
    least, most = (bound if isinstance(bound, int) else bound * n_docs for bound in (min_df, max_df))
    known = grams.frequent_hashes(blocks, tokens, least, most, once=True, **SIZES)
    return stage(grams.terms_of_blocks(blocks, known, n_docs, **SIZES))


def corpus_terms(corpus: DataFrame, vocab: DataFrame, *, stop_words=()) -> DataFrame:
    """``doc_id, term, tf`` and the other columns of ``vocab``, within that vocabulary; pass both staged.

    Texts are cut a second time here: all terms of all documents are several
    times the size of the texts and not worth storing. The tasks get the
    vocabulary as hashes, so neither texts nor terms are moved; one of more than
    ``SENT_TERMS`` is joined.
    """
    if vocab.count() > SENT_TERMS:
        return doc_terms(corpus.select("doc_id", "text"), ["doc_id"], stop_words=stop_words, within=vocab)
    blocks = grams.in_blocks(corpus.select("doc_id", "text"), clean_tokens(F.col("text"), stop_words))
    found = grams.doc_terms_of_blocks(blocks, grams.sent_hashes(vocab, **SIZES), **SIZES)
    return found if vocab.columns == ["term"] else lookup_join(found, vocab, "term", "inner")


def corpus_cooccurrence(corpus: DataFrame, vocab: DataFrame, *, stop_words=()) -> DataFrame:
    """``a, b, weight`` as of ``vocabulary.cooccurrence``, of the terms of a vocabulary so small that a row of the matrix fits in a task; pass both staged.

    A fractional lower bound of the document frequency bounds the vocabulary,
    whatever the number of documents.
    """
    blocks = grams.in_blocks(corpus.select("doc_id", "text"), clean_tokens(F.col("text"), stop_words))
    sent = grams.sent_hashes(vocab, **SIZES)
    lists = stage(grams.packed_terms_of_blocks(blocks, sent, **SIZES))
    return pairs.cooccurrence(lists, grams.by_hash(vocab, sent, **SIZES))


def document_keywords(corpus: DataFrame, *, stop_words=(), min_df: float = MIN_DF, n: int = KEYWORDS) -> DataFrame:
    """``doc_id, term, weight, rank`` by tf * idf, idf = ln((1 + docs) / (1 + df)) + 1.

    ``corpus`` is read twice, so pass it staged.
    """
    blocks, n_docs, tokens = _word_blocks(corpus, ["doc_id"], stop_words)
    least = min_df if isinstance(min_df, int) else min_df * n_docs
    known = grams.frequent_hashes(blocks, tokens, least, n_docs, once=False, **SIZES)
    heavy = grams.heaviest_of_blocks(blocks, known, n_docs, n, **SIZES)
    idf = F.log((F.lit(n_docs) + 1) / (F.col("df") + 1)) + 1
    return top_terms_per_doc(heavy.select("doc_id", "term", F.round(F.col("tf") * idf, 6).alias("weight")), n)


def _dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, product: total + product)


def with_length(vectors: DataFrame, vector: str, length: str) -> DataFrame:
    """Vectors with their length in double precision; those without a direction are dropped."""
    wide = F.col(vector).cast("array<double>")
    return vectors.withColumn(length, F.sqrt(_dot(wide, wide))).filter(F.col(length) > 0)


def vector_keywords(terms: DataFrame, doc_vectors: DataFrame, term_vectors: DataFrame, *, n: int = KEYWORDS) -> DataFrame:
    """``doc_id, term, weight, rank`` by the cosine of document and term vectors.

    Only terms that occur in a document are compared with it, so the work grows
    with the text, not with documents times terms. Vectors come with the caller,
    (doc_id, doc_vector) and (term, term_vector); lengths are taken once per
    vector, not once per pair. ``term_vectors`` is read twice.

    Terms are dealt into buckets. A document goes, with its vector, to each bucket
    that has terms of its own, which come along as packed hashes; no vector is
    moved per pair, and a bucket gives back ``n`` terms of a document. Many buckets
    are gone through some at a time.
    """
    spark = terms.sparkSession
    n_terms = term_vectors.count()
    buckets = max(spark.sparkContext.defaultParallelism, -(-n_terms // cosines.TASK_TERMS))
    docs = with_length(doc_vectors, "doc_vector", "length").withColumnRenamed("doc_vector", "vector")
    of_terms = with_length(term_vectors, "term_vector", "length").withColumnRenamed("term_vector", "vector")

    def best(found: DataFrame) -> DataFrame:
        return top_terms_per_doc(found.select("doc_id", "term", F.round("weight", 6).alias("weight")), n)

    return cosines.nearest_terms(terms.select("doc_id", "term"), docs, of_terms, n, buckets, best, n_terms <= SENT_TERMS)


def time_bins(corpus: DataFrame, *, bins: int = BINS) -> DataFrame:
    """``doc_id, date, bin``: equal-width bins from the first to the last date, 1-based."""
    at = F.unix_micros("date") / 1e6
    lo = corpus.agg(F.min(at)).scalar()
    hi = corpus.agg(F.max(at)).scalar()
    place = F.when(hi > lo, F.least(F.floor(F.lit(bins) * (at - lo) / (hi - lo)) + 1, F.lit(bins))).otherwise(1)
    return corpus.select("doc_id", "date", place.cast("int").alias("bin"))


@dataclass(frozen=True)
class Factors:
    """Non-negative factors: doc_topics (doc_id, w) and topic_terms (term, h), arrays of length ``topics``.

    ``converged`` says whether the error stood still before the rounds were used up.
    """

    doc_topics: DataFrame
    topic_terms: DataFrame
    topics: int
    converged: bool = True


def _uniform(key: str, topics: int, seed: int) -> Column:
    """Start values in (0, 1] that depend on the key alone, not on partitioning."""
    parts = [F.pmod(F.xxhash64(F.col(key), F.lit(k), F.lit(seed)), F.lit(1 << 20)) + 1 for k in range(topics)]
    return F.array(*[part / float(1 << 20) for part in parts])


def _gram(column: str, topics: int) -> Column:
    """Aggregate of a factor table: inner products of its columns, topics x topics numbers."""
    x = F.col(column)
    return F.array(*[F.array(*[F.sum(x[i] * x[j]) for j in range(topics)]) for i in range(topics)]).alias("gram")


def _solve(start: Column, target: Column, gram: Column, rounds: int) -> Column:
    """``rounds`` multiplicative updates of one row: x <- x * target / (x . gram).

    Never increases the squared error of the row and needs nothing but the row.
    """

    def update(x, _):
        def against(row):
            return F.aggregate(F.zip_with(x, row, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)

        scale = F.zip_with(target, gram, lambda t, row: t / (against(row) + F.lit(EPSILON)))
        return F.zip_with(x, scale, lambda a, b: a * b)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, update)


def _project(joined: DataFrame, by: list[str], column: str, topics: int) -> DataFrame:
    """Sum of cell weight times factor row over cells joined to a factor: ``by..., target``."""
    sums = [F.sum(F.col("weight") * F.col(column)[k]) for k in range(topics)]
    return joined.groupBy(*by).agg(F.array(*sums).alias("target"))


def factorise(cells: DataFrame, *, topics: int = TOPICS, rounds: int = ROUNDS, tolerance: float = TOLERANCE, inner: int = 3, seed: int = SEED) -> Factors:
    """Non-negative factorisation of a sparse (doc_id, term, weight) table.

    Each round solves all document rows against fixed terms, then all terms
    against fixed documents: two joins and two combinable sums over the cells. The
    error is looked at every ``LOOK_EVERY`` rounds. It ends when these lowered the
    squared error by no more than ``tolerance`` of the squared weights for each
    round, or after ``rounds``, which bounds the work where the error falls slowly
    for long; the result says which.
    Documents and terms are numbered, as their names would be moved in every
    round. The cells stay cached by document, so that the document half moves none of
    them while the terms can be broadcast; where there are too many, they are also
    cached by term, and each half moves sums only. The inner updates are local to
    a row, and both factors are checkpointed.
    """
    width = shuffle_width(cells.sparkSession)
    numbered = F.monotonically_increasing_id()
    docs = stage(cells.select("doc_id").distinct().select("doc_id", numbered.alias("d"), _uniform("doc_id", topics, seed).alias("w")))
    terms = stage(cells.select("term").distinct().select("term", numbered.alias("t"), _uniform("term", topics, seed).alias("h")))
    w = stage(docs.select("d", "w").repartition(width, "d"))
    h = stage(terms.select("t", "h").repartition(width, "t"))
    few_terms = fits_broadcast(h)
    narrow = cells.select("doc_id", "term", F.col("weight").cast("double").alias("weight")).join(docs.select("doc_id", "d"), "doc_id")
    narrow = lookup_join(narrow, terms.select("term", "t"), "term", "inner").select("d", "t", "weight")
    cells = narrow.repartition(width, "d").persist()
    by_term = cells if few_terms else cells.repartition(width, "t").persist()

    def products(factor, column) -> list[list[float]]:
        """Inner products of a factor's columns: topics x topics numbers, which the driver puts into the next plan."""
        return [[x or 0.0 for x in row] for row in factor.agg(_gram(column, topics)).first().gram]

    def solved(target, factor, key, column, of_other):
        gram = F.array(*[F.array(*map(F.lit, row)) for row in of_other])
        return stage(factor.join(target, key).select(key, _solve(F.col(column), F.col("target"), gram, inner).alias(column)))

    square = cells.agg(F.sum(F.col("weight") ** 2)).first()[0] or 0.0
    of_terms, before, converged = products(h, "h"), None, False
    for done in range(1, rounds + 1):
        met = cells.join(F.broadcast(h), "t") if few_terms else by_term.join(h, "t")
        target = _project(met, ["d"], "h", topics)
        w = solved(target, w, "d", "w", of_terms)
        of_docs = products(w, "w")
        # A fixed width, as the updates cost far more per row than the few bytes of a row suggest.
        target = _project(cells.join(w, "d"), ["t"], "w", topics).repartition(width, "t")
        looked_at = done % LOOK_EVERY == 0
        target = stage(target) if looked_at else target
        h = solved(target, h, "t", "h", of_docs)
        of_terms = products(h, "h")
        if not looked_at:
            continue
        # |X - WH|^2 = |X|^2 - 2 <W'X, H> + <W'W, HH'>: the sums of this round hold all of it.
        cross = h.join(target, "t").agg(F.sum(_dot(F.col("h"), F.col("target")))).first()[0] or 0.0
        error = square - 2 * cross + sum(of_docs[i][j] * of_terms[i][j] for i in range(topics) for j in range(topics))
        if before is not None and before - error <= LOOK_EVERY * tolerance * square:
            converged = True
            break
        before = error
    for kept in (by_term, cells):
        kept.unpersist()
    named_w = docs.select("doc_id", "d").join(w, "d").select("doc_id", "w")
    named_h = terms.select("term", "t").join(h, "t").select("term", "h")
    return Factors(stage(named_w), stage(named_h), topics, converged)


def squared_error(cells: DataFrame, factors: Factors) -> float:
    """|X - WH|^2 from sums over the non-zero cells and the inner products."""
    k = factors.topics
    fitted = F.aggregate(F.zip_with("w", "h", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    both = cells.join(factors.doc_topics, "doc_id").join(factors.topic_terms, "term")
    square, cross = both.agg(F.sum(F.col("weight") ** 2), F.sum(F.col("weight") * fitted)).first()
    left = factors.doc_topics.agg(_gram("w", k)).first().gram
    right = factors.topic_terms.agg(_gram("h", k)).first().gram
    return square - 2 * cross + sum(left[i][j] * right[i][j] for i in range(k) for j in range(k))


def doc_topics(factors: Factors) -> DataFrame:
    """``doc_id, topic, weight``"""
    return factors.doc_topics.select("doc_id", F.posexplode("w").alias("topic", "weight"))


def topic_terms(factors: Factors) -> DataFrame:
    """``topic, term, weight``"""
    return factors.topic_terms.select("term", F.posexplode("h").alias("topic", "weight")).select("topic", "term", "weight")


def topics_over_time(cells: DataFrame, factors: Factors, bins: DataFrame, *, inner: int = 30) -> DataFrame:
    """``bin, topic, term, weight``: term weights fitted per time bin with document weights held fixed.

    The documents of a bin enter only through two sums, one per (bin, term) and
    one of topics x topics numbers per bin; the fit itself is local to a row.
    """
    k = factors.topics
    placed = stage(factors.doc_topics.join(bins.select("doc_id", "bin"), "doc_id"))
    grams = placed.groupBy("bin").agg(_gram("w", k))
    joined = cells.select("doc_id", "term", "weight").join(placed, "doc_id")
    target = _project(joined, ["bin", "term"], "w", k).repartition(shuffle_width(cells.sparkSession), "bin", "term")
    # One row per time bin.
    fitted = target.join(F.broadcast(grams), "bin").select(
        "bin", "term", _solve(_uniform("term", k, SEED), F.col("target"), F.col("gram"), inner).alias("h")
    )
    return fitted.select("bin", "term", F.posexplode("h").alias("topic", "weight")).select("bin", "topic", "term", "weight")


def top_terms(terms: DataFrame, n: int = 10) -> DataFrame:
    """The heaviest terms of each topic."""
    return top_n_per_key(terms, ["topic"], [F.desc("weight"), F.asc("term")], n)


def top_documents(docs: DataFrame, n: int = 10) -> DataFrame:
    """The heaviest documents of each topic."""
    return top_n_per_key(docs, ["topic"], [F.desc("weight"), F.asc("doc_id")], n)


def lda_topics(corpus: DataFrame, *, stop_words=(), min_df: float = 0.01, topics: int = TOPICS, n: int = 10, seed: int = SEED) -> DataFrame:
    """``topic, rank, term, weight`` by latent Dirichlet allocation; texts are cut once to count and once to store, every round reads counts.

    A fractional ``min_df`` bounds the vocabulary, which the model keeps whole:
    at most (mean distinct words per text) / min_df words.
    """
    spark = corpus.sparkSession
    texts = corpus.select("doc_id", "text").repartition(pieces(spark, corpus.count(), TASK_DOCS), "doc_id")
    words = texts.select("doc_id", clean_tokens(F.col("text"), stop_words).alias("words"))
    counter = CountVectorizer(inputCol="words", outputCol="features", minDF=min_df, vocabSize=(1 << 31) - 1).fit(words)
    counts = stage(counter.transform(words).select("features"))
    model = LDA(k=topics, seed=seed, maxIter=10, subsamplingRate=1.0).fit(counts)
    names = words.sparkSession.createDataFrame(list(enumerate(counter.vocabulary)), "at int, term string")
    entry = F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("place", "entry")
    return (
        model.describeTopics(n)
        .select("topic", entry)
        .select(
            "topic",
            (F.col("place") + 1).alias("rank"),
            F.col("entry.termIndices").alias("at"),
            F.col("entry.termWeights").alias("weight"),
        )
        .join(names, "at")
        .select("topic", "rank", "term", "weight")
    )
