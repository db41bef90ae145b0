"""Named queries over a folder of test tables; each takes (spark, sf_dir)."""

from __future__ import annotations

from functools import wraps
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, ShortType

from driftline.functions import clean
from driftline.functions.stopwords import TOPIC_LANGUAGES, stop_words
from driftline.functions.text import ngrams, tokens
from driftline.operators import centrality, graph, messages, names, snowball, textstats, topics, vocabulary
from driftline.plans import names as names_job
from driftline.session import stage, working_path
from driftline.sinks.files import write_appended, write_csv, write_json
from driftline.sinks.tiles import write_tiles
from driftline.sources import fixtures, tables
from driftline.schemas import MESSAGES
from driftline.streaming import collection

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters of the queries.
MATRIX_TARGETS = ("src0", "src12", "src16", "src4", "src8")
SEEDS = ("101", "@ch_102", "https://t.me/no_such_channel")
MAX_DEPTH = 2
POSTS_PER_CHANNEL = 5
KEYWORDS = ("", "the", "und")
READ_LIMIT = 30
RANGE = ("2024-01-02 00:00:00", "2024-02-15 23:59:59")
SHIP_RANGE = ("1995-01-01 00:00:00", "1996-12-31 23:59:59")
STREAM_RANGE = ("2024-01-03 00:00:00", None)
# The titles of the test data hold no articles; two of their adjectives stand in.
FUNCTION_WORDS = names.ARTICLES_AND_PREPOSITIONS + ("new", "small")
NAME_MIN_DF, NAME_MAX_DF = 0.01, 0.9
MESSAGE_WORD_MIN_DF = 0.1
# Messages of a stored file.
STORED_FILE = 100_000


def query(fn):
    """Register under the function's name (less a ``q_`` that keeps it apart from an import); results in a UTC session, whole numbers as long."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        result = fn(spark, sf_dir)
        narrow = [f.name for f in result.schema.fields if isinstance(f.dataType, (ByteType, ShortType, IntegerType))]
        return result.withColumns({name: F.col(name).cast("long") for name in narrow}) if narrow else result

    QUERIES[fn.__name__.removeprefix("q_")] = run
    return run


def _iso(column: str):
    return clean.iso_utc(F.col(column)).alias(column)


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name, kind in df.dtypes if kind == "double"})


# --- forward edges and graph -------------------------------------------------


def _edges(spark, sf_dir, **options):
    parts = fixtures.relation_pieces(spark, sf_dir)
    return graph.forward_edges(fixtures.relation_groups(spark, sf_dir), copies="copies", parts=parts, **options)


@query
def forward_edges(spark, sf_dir):
    return graph.sorted_edges(_edges(spark, sf_dir))


@query
def forward_edges_all(spark, sf_dir):
    return graph.sorted_edges(_edges(spark, sf_dir, include_unresolved=True))


@query
def edge_labels(spark, sf_dir):
    labelled = graph.label_relations(fixtures.relations(spark, sf_dir))
    return labelled.select("channel_to_id", "target_message_id", _iso("target_message_date_utc"), "source", "target", "unresolved")


@query
def relation_matrix_long(spark, sf_dir):
    return graph.relation_matrix_long(_edges(spark, sf_dir, include_unresolved=True))


@query
def relation_matrix(spark, sf_dir):
    return graph.relation_matrix(graph.forward_edges(fixtures.chat_relations(spark, sf_dir)), MATRIX_TARGETS)


@query
def relation_rows(spark, sf_dir):
    """The rows of the whole matrix, each written as text."""
    cells = F.transform(F.map_entries("cells"), lambda cell: F.concat_ws("=", cell["key"], cell["value"]))
    return graph.relation_rows(_edges(spark, sf_dir), parts=fixtures.relation_pieces(spark, sf_dir)).select("source", F.array_join(cells, "|").alias("cells"))


@query
def matrix_summary(spark, sf_dir):
    return graph.matrix_summary(_edges(spark, sf_dir))


@query
def graph_nodes(spark, sf_dir):
    return graph.export_nodes(graph.graph_edges(_edges(spark, sf_dir), min_weight=2))


@query
def graph_edges(spark, sf_dir):
    return graph.export_edges(graph.graph_edges(_edges(spark, sf_dir), min_weight=2))


@query
def graph_summary(spark, sf_dir):
    return graph.graph_summary(graph.graph_edges(_edges(spark, sf_dir), min_weight=2))


@query
def top_edges(spark, sf_dir):
    return graph.top_edges(_edges(spark, sf_dir))


# --- references, cells, dates ------------------------------------------------


@query
def normalize_refs(spark, sf_dir):
    return fixtures.raw_refs(spark, sf_dir).withColumn("ref", clean.channel_ref(F.col("raw")))


@query
def normalize_names(spark, sf_dir):
    return fixtures.raw_refs(spark, sf_dir).withColumn("name", clean.channel_name(F.col("raw")))


@query
def safe_int(spark, sf_dir):
    numbers = fixtures.raw_numbers(spark, sf_dir)
    raw = F.col("raw")
    return numbers.withColumn("parsed", clean.safe_int(raw)).withColumn("at_least_one", clean.safe_int(raw, 40, 1))


@query
def date_bounds(spark, sf_dir):
    dates = fixtures.raw_dates(spark, sf_dir)
    lower = clean.iso_utc(clean.date_bound(F.col("raw"), is_end=False))
    upper = clean.iso_utc(clean.date_bound(F.col("raw"), is_end=True))
    return dates.select("order_id", "raw", lower.alias("lower_bound"), upper.alias("upper_bound"))


@query
def forward_source(spark, sf_dir):
    posts = messages.with_forward_origin(fixtures.header_posts(fixtures.table(spark, sf_dir, "events")))
    return posts.select("message_id", "is_forwarded", "forward_from_chat")


# --- messages ----------------------------------------------------------------


def _collected(spark, sf_dir):
    return messages.collect_messages(
        fixtures.messages(spark, sf_dir), keywords=KEYWORDS, start=RANGE[0], end=RANGE[1], limit=READ_LIMIT
    )


@query
def channel_list(spark, sf_dir):
    return messages.channel_list(fixtures.raw_refs(spark, sf_dir), "raw")


@query
def pending_channels(spark, sf_dir):
    channels = fixtures.channels(spark, sf_dir)
    early = messages.messages_in_range(fixtures.table(spark, sf_dir, "lineitem"), None, SHIP_RANGE[0], column="l_shipdate")
    done = early.select(F.concat(F.lit("ch_"), F.col("l_partkey").cast("string")).alias("channel_username"))
    return messages.pending_channels(messages.channel_list(channels), messages.channel_trace(done))


@query
def latest_posts(spark, sf_dir):
    newest = messages.latest_posts(fixtures.posts(spark, sf_dir), POSTS_PER_CHANNEL)
    return newest.select("channel_id", "message_id", _iso("date"), "is_forwarded", "from_id", "rank")


@query
def keyword_posts(spark, sf_dir):
    found = messages.keyword_posts(fixtures.messages(spark, sf_dir), KEYWORDS, 10)
    return found.select("channel_username", "keyword", "message_id", "rank")


@query
def keyword_counts(spark, sf_dir):
    """Posts that hold each of some thousand keywords, the stop words of all languages there are lists of."""
    found = messages.match_keywords(fixtures.messages(spark, sf_dir), stop_words())
    return found.groupBy("keyword").agg(F.count(F.lit(1)).alias("posts"))


@query
def messages_in_range(spark, sf_dir):
    kept = messages.messages_in_range(fixtures.table(spark, sf_dir, "lineitem"), *SHIP_RANGE, column="l_shipdate")
    return kept.select(
        F.col("l_partkey").alias("channel_id"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("message_id"),
        clean.iso_utc(F.col("l_shipdate").cast("timestamp")).alias("date"),
    )


@query
def message_records(spark, sf_dir):
    return _collected(spark, sf_dir).withColumn("date", clean.iso_utc(F.col("date")))


@query
def channel_trace(spark, sf_dir):
    return messages.channel_trace(_collected(spark, sf_dir))


@query
def messages_per_channel(spark, sf_dir):
    return messages.messages_per_channel(messages.message_record(fixtures.messages(spark, sf_dir)))


@query
def collection_totals(spark, sf_dir):
    return messages.collection_totals(messages.message_record(fixtures.messages(spark, sf_dir)))


@query
def top_forward_sources(spark, sf_dir):
    return messages.top_forward_sources(messages.message_record(fixtures.messages(spark, sf_dir)))


# --- snowball sampling -------------------------------------------------------


def _seeds(spark):
    return spark.range(1).select(F.explode(F.array(*[F.lit(seed) for seed in SEEDS])).alias("ref"))


def _sample(spark, sf_dir, max_depth=MAX_DEPTH):
    return snowball.snowball(
        fixtures.posts(spark, sf_dir),
        fixtures.channels(spark, sf_dir),
        _seeds(spark),
        max_depth=max_depth,
        posts_per_channel=POSTS_PER_CHANNEL,
    )


def _compared(records):
    return records.drop("date_collected_utc")


@query
def snowball_channels(spark, sf_dir):
    keyed = _compared(_sample(spark, sf_dir).channels)
    return keyed.withColumn("channel_key", clean.channel_key(F.col("channel_id"))).orderBy("discovered_depth", "username")


@query
def snowball_relations(spark, sf_dir):
    found = _sample(spark, sf_dir).relations
    return found.withColumn("target_message_date_utc", clean.iso_utc(F.col("target_message_date_utc")))


@query
def snowball_summary(spark, sf_dir):
    return snowball.snowball_summary(_sample(spark, sf_dir))


@query
def resume_seeds(spark, sf_dir):
    return snowball.resume_seeds(fixtures.earlier_channels(spark, sf_dir))


@query
def snowball_resume(spark, sf_dir):
    earlier = _sample(spark, sf_dir, max_depth=1).channels
    more = snowball.resume(
        earlier,
        fixtures.posts(spark, sf_dir),
        fixtures.channels(spark, sf_dir),
        max_depth=3,
        posts_per_channel=POSTS_PER_CHANNEL,
    )
    return _compared(more.channels)


@query
def snowball_restart(spark, sf_dir):
    """A run that ends after level 0 and is started again, from no posts but those it has kept."""
    log = working_path(spark, "snowball-log")
    posts, channels = fixtures.posts(spark, sf_dir), fixtures.channels(spark, sf_dir)
    options = {"max_depth": MAX_DEPTH, "posts_per_channel": POSTS_PER_CHANNEL}
    snowball.snowball_logged(posts, channels, _seeds(spark), log, last_level=0, **options)
    found = snowball.snowball_logged(posts.limit(0), channels, _seeds(spark), log, **options).relations
    return found.withColumn("target_message_date_utc", clean.iso_utc(F.col("target_message_date_utc")))


# --- stored tables -----------------------------------------------------------


@query
def channels_scan(spark, sf_dir):
    """Channels written as the files of three runs, then read as one table."""
    path = working_path(spark, "channels")
    stored = fixtures.channels(spark, sf_dir)
    for run in range(3):
        write_csv(stored.filter(F.col("channel_id") % 3 == run), path, run_id=f"r{run}")
    run_folder = F.regexp_extract("source_file", r"run_id=(\w+)", 1)
    read = tables.read_channels(spark, path).select("channel_id", "username", "title", run_folder.alias("source_file"))
    return read.withColumns({name: clean.clean_cell(F.col(name)) for name in ("username", "title")})


@query
def relations_scan(spark, sf_dir):
    path = write_csv(fixtures.relations(spark, sf_dir), working_path(spark, "relations"))
    read = tables.read_relations(spark, path).withColumn("target_message_date_utc", clean.iso_utc(F.col("target_message_date_utc")))
    text = [name for name, kind in read.dtypes if kind == "string"]
    return read.withColumns({name: clean.clean_cell(F.col(name)) for name in text})


@query
def csv_roundtrip(spark, sf_dir):
    """Messages with quotes and line breaks appended by two runs, all read back."""
    path = working_path(spark, "messages")
    records = messages.message_record(fixtures.messages(spark, sf_dir))
    even = F.col("message_id") % 2 == 0
    write_appended(records.filter(even), path, "a")
    write_appended(records.filter(~even), path, "b")
    read = tables.read_csv(spark, [f"{path}/run_id=a", f"{path}/run_id=b"], MESSAGES)
    return read.withColumn("date", F.when(F.col("date").isNotNull(), clean.iso_utc(F.col("date"))))


@query
def relation_matrix_tiles(spark, sf_dir):
    """All cells of the matrix, zeros included, written in tiles of sixteen targets and read back."""
    edges = _edges(spark, sf_dir, include_unresolved=True)
    return tables.read_tiles(spark, write_tiles(edges, working_path(spark, "tiles"), width=16, compression="gzip"))


@query
def topic_corpus_scan(spark, sf_dir):
    """The corpus of messages that were stored as one file per some 100,000, with line breaks in cells."""
    stored = fixtures.messages(spark, sf_dir).select("channel_username", "message_id", "date", "text")
    files = max(1, -(-fixtures.table(spark, sf_dir, "documents").count() // STORED_FILE))
    path = write_csv(stored.coalesce(files), working_path(spark, "stored-messages"))
    return topics.topic_corpus(tables.read_messages(spark, path)).withColumn("date", clean.iso_utc(F.col("date")))


@query
def latest_snapshot(spark, sf_dir):
    family = working_path(spark, "snapshots")
    stored = fixtures.channels(spark, sf_dir).select("channel_id", "title")
    write_csv(stored.withColumn("title", F.lit("old")), family, run_id="1")
    write_csv(stored, family, run_id="2")
    newest = tables.latest_snapshot(spark, family)
    return tables.read_csv(spark, newest, "channel_id long, title string").withColumn("title", clean.clean_cell(F.col("title")))


# --- channel names -----------------------------------------------------------


def _names(spark, sf_dir):
    files = F.concat(F.lit("run_"), (F.col("channel_id") % 3).cast("string"))
    return names.name_table(fixtures.channels(spark, sf_dir).withColumn("source_file", files))


def _name_vocabulary(spark, sf_dir):
    """Distinct names with their copies, and the vocabulary, both staged."""
    texts = stage(vocabulary.distinct_texts(_names(spark, sf_dir), "name"))
    n_docs = texts.agg(F.sum("copies")).scalar()
    bounds = {"min_df": NAME_MIN_DF, "max_df": NAME_MAX_DF}
    return texts, stage(vocabulary.vocabulary(texts, n_docs, stop_words=stop_words(), **bounds))


def _name_terms(spark, sf_dir):
    texts, vocab = _name_vocabulary(spark, sf_dir)
    return vocabulary.text_terms(texts, stop_words=stop_words(), within=vocab.select("term")), vocab


def _name_graph(spark, sf_dir):
    terms, vocab = _name_terms(spark, sf_dir)
    return vocab, vocab.select(F.col("term").alias("token")), stage(vocabulary.cooccurrence(terms))


def _features(spark, sf_dir):
    return names.name_features(_names(spark, sf_dir), function_words=FUNCTION_WORDS)


def _name_zipf(spark, sf_dir):
    return names.zipf_table(vocabulary.word_frequency(_name_vocabulary(spark, sf_dir)[1]))


@query
def name_table(spark, sf_dir):
    return _names(spark, sf_dir)


@query
def name_features(spark, sf_dir):
    return _features(spark, sf_dir)


@query
def name_length_stats(spark, sf_dir):
    return _rounded(names.length_stats(_features(spark, sf_dir)))


@query
def length_histogram(spark, sf_dir):
    return _rounded(names.length_histogram(_features(spark, sf_dir)))


@query
def name_summary(spark, sf_dir):
    """The summary written as JSON and read back, its Zipf line unnested."""
    channels = fixtures.channels(spark, sf_dir)
    fit = stage(names.zipf_fit(_name_zipf(spark, sf_dir)))
    summary = names.name_summary(channels, _features(spark, sf_dir), fit)
    path = write_json(summary, working_path(spark, "summary"))
    read = spark.read.schema(summary.schema).json(path)
    flat = read.select("*", F.col("zipf.slope").alias("zipf_slope"), F.col("zipf.intercept").alias("zipf_intercept"))
    return _rounded(flat.drop("zipf", "generated_at_utc"))


@query
def q_tokens(spark, sf_dir):
    words = tokens(F.col("name"))
    return _names(spark, sf_dir).select("channel_id", F.posexplode(words).alias("position", "token"))


@query
def tokens_clean(spark, sf_dir):
    words = vocabulary.clean_tokens(F.col("name"), stop_words())
    return _names(spark, sf_dir).select("channel_id", F.posexplode(words).alias("position", "token"))


@query
def q_ngrams(spark, sf_dir):
    words = vocabulary.clean_tokens(F.col("name"), stop_words()).alias("words")
    listed = _names(spark, sf_dir).select("channel_id", words)
    exploded = listed.select("channel_id", F.explode(ngrams(F.col("words"))).alias("term"))
    return exploded.groupBy("channel_id", "term").agg(F.count(F.lit(1)).alias("tf"))


@query
def stopwords(spark, sf_dir):
    """How often each stop word of the joined lists occurs in the documents."""
    unwanted = stop_words()
    found = F.filter(tokens(F.col("text")), lambda word: word.isin(unwanted))
    documents = tables.spread(fixtures.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    words = documents.select(F.explode(found).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("occurrences"))


@query
def q_vocabulary(spark, sf_dir):
    return _name_vocabulary(spark, sf_dir)[1]


@query
def doc_terms(spark, sf_dir):
    return _name_terms(spark, sf_dir)[0]


@query
def word_frequency(spark, sf_dir):
    return vocabulary.word_frequency(_name_vocabulary(spark, sf_dir)[1])


@query
def top_tokens(spark, sf_dir):
    return vocabulary.top_tokens(_name_vocabulary(spark, sf_dir)[1])


@query
def word_cooccurrence(spark, sf_dir):
    return _name_graph(spark, sf_dir)[2]


@query
def word_graph(spark, sf_dir):
    vocab, _, pairs = _name_graph(spark, sf_dir)
    return vocabulary.word_graph(vocab, pairs)


@query
def word_degree(spark, sf_dir):
    _, nodes, pairs = _name_graph(spark, sf_dir)
    return _rounded(centrality.degrees(nodes, pairs))


@query
def word_betweenness(spark, sf_dir):
    _, nodes, pairs = _name_graph(spark, sf_dir)
    return _rounded(centrality.betweenness(nodes, pairs))


@query
def word_centrality(spark, sf_dir):
    _, nodes, pairs = _name_graph(spark, sf_dir)
    return _rounded(centrality.word_centrality(nodes, pairs))


@query
def word_files(spark, sf_dir):
    """Word frequencies as the job over channel files stores them, read back from its files."""
    out = working_path(spark, "names-job")
    write_csv(fixtures.channels(spark, sf_dir), f"{out}/channels", run_id="1")
    names_job.run(spark, f"{out}/channels", out, run_id="1", min_df=NAME_MIN_DF, max_df=NAME_MAX_DF)
    return tables.read_csv(spark, f"{out}/word_frequency/run_id=1", "word string, frequency long")


@query
def zipf_table(spark, sf_dir):
    return _rounded(_name_zipf(spark, sf_dir))


@query
def zipf_fit(spark, sf_dir):
    return _rounded(names.zipf_fit(_name_zipf(spark, sf_dir)))


# --- topics ------------------------------------------------------------------


def _corpus(spark, sf_dir):
    return stage(topics.topic_corpus(fixtures.messages(spark, sf_dir)))


def _keywords(corpus):
    return topics.document_keywords(corpus, stop_words=stop_words(TOPIC_LANGUAGES))


def _model(spark, sf_dir):
    """Staged corpus, cells and the factors fitted on them."""
    corpus = _corpus(spark, sf_dir)
    cells = stage(_keywords(corpus))
    return corpus, cells, topics.factorise(cells)


@query
def topic_corpus(spark, sf_dir):
    return _corpus(spark, sf_dir).withColumn("date", clean.iso_utc(F.col("date")))


@query
def topic_keywords(spark, sf_dir):
    return _keywords(_corpus(spark, sf_dir))


@query
def vector_keywords(spark, sf_dir):
    corpus = _corpus(spark, sf_dir)
    unwanted = stop_words(TOPIC_LANGUAGES)
    vocab = topics.corpus_vocabulary(corpus, stop_words=unwanted)
    return topics.vector_keywords(
        topics.corpus_terms(corpus, vocab.select("term"), stop_words=unwanted),
        fixtures.doc_vectors(spark, sf_dir, corpus),
        fixtures.term_vectors(spark, sf_dir, vocab),
    )


@query
def topic_time_bins(spark, sf_dir):
    return topics.time_bins(_corpus(spark, sf_dir)).select("doc_id", "bin")


@query
def topic_terms(spark, sf_dir):
    return topics.topic_terms(_model(spark, sf_dir)[2])


@query
def doc_topics(spark, sf_dir):
    return topics.doc_topics(_model(spark, sf_dir)[2])


@query
def topics_over_time(spark, sf_dir):
    corpus, cells, factors = _model(spark, sf_dir)
    return topics.topics_over_time(cells, factors, topics.time_bins(corpus))


@query
def topic_top_terms(spark, sf_dir):
    return topics.top_terms(topics.topic_terms(_model(spark, sf_dir)[2]))


@query
def topic_top_docs(spark, sf_dir):
    return topics.top_documents(topics.doc_topics(_model(spark, sf_dir)[2]))


@query
def lda_topics(spark, sf_dir):
    return topics.lda_topics(_corpus(spark, sf_dir), stop_words=stop_words(TOPIC_LANGUAGES))


# --- message texts -----------------------------------------------------------


def _texts(spark, sf_dir):
    return tables.spread(fixtures.messages(spark, sf_dir), "message_id").filter(F.col("text").isNotNull())


def _term_frequency(spark, sf_dir):
    words = _texts(spark, sf_dir).select(F.explode(tokens(F.col("text"))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("frequency"))


@query
def message_term_freq(spark, sf_dir):
    return _term_frequency(spark, sf_dir)


@query
def message_ngrams(spark, sf_dir):
    return topics.corpus_vocabulary(_corpus(spark, sf_dir), stop_words=stop_words(TOPIC_LANGUAGES))


@query
def message_lengths(spark, sf_dir):
    return textstats.text_lengths(_texts(spark, sf_dir))


@query
def message_length_histogram(spark, sf_dir):
    # A few numbers per message; staged so that the texts are read once.
    lengths = stage(textstats.text_lengths(_texts(spark, sf_dir)).select("word_count", "char_count"))
    return _rounded(names.length_histogram(lengths))


@query
def sentence_length(spark, sf_dir):
    return _rounded(textstats.sentence_length(textstats.text_lengths(_texts(spark, sf_dir))))


@query
def letters_per_word(spark, sf_dir):
    return _rounded(textstats.letters_per_word(textstats.text_lengths(_texts(spark, sf_dir))))


@query
def gulpease(spark, sf_dir):
    return _rounded(textstats.gulpease(textstats.text_lengths(_texts(spark, sf_dir))))


@query
def message_zipf(spark, sf_dir):
    return _rounded(names.zipf_fit(names.zipf_table(_term_frequency(spark, sf_dir))))


@query
def message_word_centrality(spark, sf_dir):
    corpus = _corpus(spark, sf_dir)
    docs, single = corpus.select("doc_id", "text"), {"stop_words": stop_words(), "highest": 1}
    n_docs = corpus.agg(F.count(F.lit(1))).scalar()
    vocab = stage(vocabulary.vocabulary(docs, n_docs, min_df=MESSAGE_WORD_MIN_DF, max_df=NAME_MAX_DF, **single))
    pairs = stage(vocabulary.cooccurrence(vocabulary.doc_terms(docs, ["doc_id"], within=vocab.select("term"), **single)))
    return _rounded(centrality.word_centrality(vocab.select(F.col("term").alias("token")), pairs))


@query
def message_term_centrality(spark, sf_dir):
    """Runs of up to three words in 1 to 90 % of the messages, the bounds of the channel names, and in at least five of them.

    Below 500 messages a hundredth is no bound: every run that is met twice would be a node.
    """
    corpus = _corpus(spark, sf_dir)
    vocab = topics.corpus_vocabulary(corpus, stop_words=stop_words(), min_df=NAME_MIN_DF, max_df=NAME_MAX_DF)
    vocab = stage(vocab.filter(F.col("df") >= topics.MIN_DF))
    pairs = topics.corpus_cooccurrence(corpus, vocab, stop_words=stop_words())
    return _rounded(centrality.word_centrality(vocab.select(F.col("term").alias("token")), pairs))


# --- streams -----------------------------------------------------------------


def _event_stream(spark, sf_dir, folder=None):
    schema = fixtures.table(spark, sf_dir, "events").schema
    glob = None if folder else "events.parquet"
    return fixtures.header_posts(collection.message_stream(spark, folder or sf_dir, schema, glob=glob))


def _drain(records, spark, name):
    target = working_path(spark, name)
    collection.append(records, target, working_path(spark, f"{name}-log")).awaitTermination()
    return spark.read.parquet(target).withColumn("date", clean.iso_utc(F.col("date")))


@query
def stream_collect(spark, sf_dir):
    records = collection.collected(_event_stream(spark, sf_dir), start=STREAM_RANGE[0], end=STREAM_RANGE[1])
    return _drain(records, spark, "collected")


@query
def stream_dedup(spark, sf_dir):
    """Four files arrive one by one, the late half of the ids first, each half twice; every message is kept once."""
    events = fixtures.table(spark, sf_dir, "events")
    inbox, target, keys, log = (working_path(spark, name) for name in ("inbox", "first", "first-keys", "first-log"))
    middle = events.agg(F.avg("event_id")).first()[0] or 0
    for late in (True, True, False, False):
        part = events.filter(F.col("event_id") > middle) if late else events.filter(F.col("event_id") <= middle)
        part.write.mode("append").parquet(inbox)
        records = collection.collected(_event_stream(spark, sf_dir, inbox))
        collection.append_new(records, target, keys, log).awaitTermination()
    return spark.read.parquet(target).drop("batch").withColumn("date", clean.iso_utc(F.col("date")))


@query
def stream_dedup_merged(spark, sf_dir):
    """Twelve files with copies, a batch each, and an index merged at every second run; every message is kept once."""
    events = fixtures.table(spark, sf_dir, "events")
    inbox, target, keys, log = (working_path(spark, name) for name in ("inbox", "merged", "merged-keys", "merged-log"))
    parts = events.withColumn("part", F.explode(F.array(F.pmod(F.xxhash64("event_id"), F.lit(12)), F.pmod("event_id", F.lit(12)))))
    parts.repartition(12, "part").drop("part").write.parquet(inbox)
    schema = fixtures.table(spark, sf_dir, "events").schema
    posts = fixtures.header_posts(collection.message_stream(spark, inbox, schema, files_per_batch=1))
    collection.append_new(collection.collected(posts), target, keys, log, fan=2).awaitTermination()
    return spark.read.parquet(target).drop("batch").withColumn("date", clean.iso_utc(F.col("date")))


@query
def stream_flush(spark, sf_dir):
    """One half is written by a timed flush; the other arrives as the collection is told to stop, and is written by the last one."""
    events = fixtures.table(spark, sf_dir, "events")
    inbox, target, log = (working_path(spark, name) for name in ("inbox", "flushed", "flushed-log"))
    events.filter(F.col("event_id") % 2 == 0).write.mode("append").parquet(inbox)

    def start(interval):
        return collection.append(collection.collected(_event_stream(spark, sf_dir, inbox)), target, log, interval_seconds=interval)

    def stop(running):
        if not any(progress["numInputRows"] for progress in running.recentProgress):
            return False
        events.filter(F.col("event_id") % 2 == 1).write.mode("append").parquet(inbox)
        return True

    collection.collect_until(start, stop, interval_seconds=1)
    return spark.read.parquet(target).withColumn("date", clean.iso_utc(F.col("date")))


@query
def stream_resume(spark, sf_dir):
    """Two halves arrive one after the other; each run only reads what is new."""
    events = fixtures.table(spark, sf_dir, "events")
    inbox, target, log = (working_path(spark, name) for name in ("inbox", "resumed", "resumed-log"))
    for half in (0, 1):
        events.filter(F.col("event_id") % 2 == half).write.mode("append").parquet(inbox)
        for _ in range(2):
            posts = _event_stream(spark, sf_dir, inbox)
            collection.append(collection.collected(posts), target, log).awaitTermination()
    return spark.read.parquet(target).withColumn("date", clean.iso_utc(F.col("date")))


@query
def stream_trace(spark, sf_dir):
    target = working_path(spark, "trace")
    records = collection.collected(_event_stream(spark, sf_dir))
    collection.append_trace(records, target, working_path(spark, "trace-log")).awaitTermination()
    return collection.read_trace(spark, target)


@query
def stream_trace_merged(spark, sf_dir):
    """Nine files, a batch each; the counts of every three batches, and of every three of those, are added up."""
    events = fixtures.table(spark, sf_dir, "events")
    inbox, target, log = (working_path(spark, name) for name in ("inbox", "sums", "sums-log"))
    events.repartition(9, "event_id").write.parquet(inbox)
    posts = fixtures.header_posts(collection.message_stream(spark, inbox, events.schema, files_per_batch=1))
    collection.append_trace(collection.collected(posts), target, log, fan=3).awaitTermination()
    return collection.read_trace(spark, target, fan=3)
