import glob
import math
import time
from datetime import datetime

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from driftline import queries, session
from driftline.functions.stopwords import TOPIC_LANGUAGES, stop_words
from driftline.operators import cosines, joins, pairs, topics, vocabulary
from driftline.sinks import files
from driftline.sources.fixtures import messages

MESSAGE = "message_id long, channel_username string, date timestamp, text string"


def test_first_copy_decides_before_the_date_is_looked_at(spark):
    day = datetime(2024, 1, 1)
    given = [
        (1, "a", None, "same"),
        (2, "a", day, "same"),
        (3, "a", day, "other"),
        (4, "b", day, "other"),
        (5, "a", day, None),
        (6, "a", day, "  "),
        (7, "a", day, "https://only.link"),
        (3, "b", day, "a third"),
    ]
    corpus = topics.topic_corpus(spark.createDataFrame(given, MESSAGE))
    assert rows(corpus, "channel_username", "message_id", "text") == [("a", 3, "other"), ("a", 7, ""), ("b", 3, "a third")]
    assert corpus.select("doc_id").distinct().count() == 3


def test_messages_of_two_channels_with_one_id_stay_apart(spark):
    day = datetime(2024, 1, 1)
    given = [(1, "a", day, "xx yy yy"), (1, "b", day, "zz"), (2, "a", day, "xx zz")]
    corpus = topics.topic_corpus(spark.createDataFrame(given, MESSAGE))
    found = topics.document_keywords(corpus, min_df=1, n=9).join(corpus.select("doc_id", "channel_username", "message_id"), "doc_id")
    terms = {}
    for row in found.collect():
        terms.setdefault((row.channel_username, row.message_id), set()).add(row.term)
    assert terms == {("a", 1): {"xx", "yy", "xx yy", "yy yy", "xx yy yy"}, ("b", 1): {"zz"}, ("a", 2): {"xx", "zz", "xx zz"}}


def test_keywords(spark):
    given = [(i, datetime(2024, 1, 1), text) for i, text in enumerate(["xx yy yy", "xx zz", "xx zz zz zz", "xx"])]
    corpus = spark.createDataFrame(given, "doc_id long, date timestamp, text string")
    found = topics.document_keywords(corpus, min_df=2, n=1)
    idf = math.log(5 / 3) + 1
    assert rows(found) == [(0, "xx", 1.0, 1), (1, "xx zz", round(idf, 6), 1), (2, "zz", round(3 * idf, 6), 1), (3, "xx", 1.0, 1)]


def test_vector_keywords_compare_only_terms_of_the_document(spark):
    terms = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "c")], "doc_id long, term string")
    docs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0])], "doc_id long, doc_vector array<float>")
    words = spark.createDataFrame([("a", [1.0, 1.0]), ("b", [3.0, 0.0]), ("c", [0.0, 0.0])], "term string, term_vector array<float>")
    half = round(math.sqrt(0.5), 6)
    assert rows(topics.vector_keywords(terms, docs, words)) == [(1, "a", half, 2), (1, "b", 1.0, 1), (2, "a", half, 1)]


def test_vector_keywords_move_no_vector_per_pair(spark, monkeypatch):
    """Pairs of documents and terms were joined with both vectors; now a document asks a bucket of terms, with packed hashes."""
    monkeypatch.setattr(topics, "lookup_join", lambda *args, **options: pytest.fail("joined"))
    monkeypatch.setattr(cosines, "TASK_TERMS", 3)
    monkeypatch.setattr(cosines, "PACKED_ROWS", 4)
    numbers = spark.range(12).withColumn("x", F.col("id").cast("float"))
    docs = numbers.select(F.col("id").alias("doc_id"), F.array(F.col("x"), F.lit(1.0).cast("float")).alias("doc_vector"))
    words = numbers.select(F.concat(F.lit("t"), "id").alias("term"), F.array(F.lit(1.0).cast("float"), F.col("x") - 5).alias("term_vector"))
    # One word twice, one without a direction, one of another size, one without a vector.
    more = spark.createDataFrame([("t1", [1.0, 0.0]), ("none", [0.0, 0.0]), ("long", [1.0, 2.0, 3.0])], "term string, term_vector array<float>")
    words = words.unionByName(more)
    names = [f"t{i}" for i in range(12)] + ["none", "long", "unknown"]
    terms = docs.select("doc_id", F.explode(F.array(*map(F.lit, names))).alias("term")).filter(F.xxhash64("doc_id", "term") % 3 != 0)
    vectors = [(r.term, r.term_vector) for r in words.collect()]
    expected = []
    for doc, vector in ((r.doc_id, r.doc_vector) for r in docs.collect()):
        own = {r.term for r in terms.filter(F.col("doc_id") == doc).collect()}
        found = [(t, None if len(v) != 2 else round(sum(a * b for a, b in zip(vector, v)) / math.hypot(*vector) / math.hypot(*v), 6)) for t, v in vectors if t in own and any(v)]
        found.sort(key=lambda x: (math.inf if x[1] is None else -x[1], x[0]))
        expected += [(doc, t, w, k + 1) for k, (t, w) in enumerate(found[:4])]
    assert rows(topics.vector_keywords(terms, docs, words, n=4)) == sorted(expected, key=str)


def test_weights_are_rounded_as_by_sql(spark):
    given = [0.1234565, -0.1234565, 0.9999995, 1e-7, 0.5000005, 0.0000015, -0.33333349999999996, 0.2]
    found = spark.createDataFrame([(x,) for x in given], "x double").select(F.round("x", 6)).collect()
    assert [r[0] for r in found] == [x / 1e6 for x in cosines.millionths(np.array(given))]


def test_corpus_terms_by_hash_move_no_texts(spark, sf, monkeypatch):
    corpus = session.stage(topics.topic_corpus(messages(spark, sf)))
    vocab = session.stage(topics.corpus_vocabulary(corpus, stop_words=stop_words(TOPIC_LANGUAGES))).select("term", "df")
    plain = vocabulary.doc_terms(corpus.select("doc_id", "text"), ["doc_id"], stop_words=stop_words(TOPIC_LANGUAGES), within=vocab)
    names = ("doc_id", "term", "tf", "df")
    expected = rows(plain, *names)
    monkeypatch.setattr(topics, "doc_terms", lambda *args, **options: pytest.fail("joined"))
    found = topics.corpus_terms(corpus, vocab, stop_words=stop_words(TOPIC_LANGUAGES))
    assert expected and rows(found, *names) == expected


def test_cooccurrence_in_stripes(spark, sf, monkeypatch):
    """Every pair of terms of a text was a row; now stripes of the matrix are added up by tasks."""
    monkeypatch.setattr(pairs, "CELLS", 5000)
    monkeypatch.setattr(pairs, "PAIRS", 100)
    corpus = session.stage(topics.topic_corpus(messages(spark, sf)))
    vocab = topics.corpus_vocabulary(corpus, stop_words=stop_words(), min_df=0.1, max_df=0.9)
    n = corpus.count()
    plain = vocabulary.vocabulary(corpus.select("doc_id", "text"), F.lit(n), stop_words=stop_words(), min_df=0.1, max_df=0.9)
    assert rows(vocab) == rows(plain) and vocab.count() > 50
    expected = vocabulary.cooccurrence(vocabulary.doc_terms(corpus.select("doc_id", "text"), ["doc_id"], stop_words=stop_words(), within=vocab.select("term")))
    assert rows(topics.corpus_cooccurrence(corpus, vocab, stop_words=stop_words())) == rows(expected)
    assert rows(topics.corpus_cooccurrence(corpus, vocab.limit(0))) == []


@pytest.fixture(scope="module")
def cells(spark):
    weight = F.pmod(F.xxhash64("doc_id", "t"), F.lit(5)) + 1
    grid = spark.range(0, 40).withColumnRenamed("id", "doc_id").withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(11))))
    kept = grid.filter(F.pmod(F.col("doc_id") + F.col("t"), F.lit(3)) > 0)
    return kept.select("doc_id", F.concat(F.lit("t"), F.col("t").cast("string")).alias("term"), weight.cast("double").alias("weight")).persist()


def test_factors(spark, cells):
    errors = []
    for rounds in (1, 3, 6):
        factors = topics.factorise(cells, topics=3, rounds=rounds)
        assert factors.doc_topics.count() == 40 and factors.topic_terms.count() == 12
        assert topics.topic_terms(factors).filter("weight < 0 OR weight IS NULL OR isnan(weight)").count() == 0
        assert topics.doc_topics(factors).filter("weight < 0 OR weight IS NULL OR isnan(weight)").count() == 0
        errors.append(topics.squared_error(cells, factors))
    assert errors == sorted(errors, reverse=True)
    assert errors[-1] < cells.agg(F.sum(F.col("weight") ** 2)).first()[0] / 2


def test_error_equals_the_dense_formula(spark, cells):
    factors = topics.factorise(cells, topics=2, rounds=1)
    w = {r.doc_id: r.w for r in factors.doc_topics.collect()}
    h = {r.term: r.h for r in factors.topic_terms.collect()}
    x = {(r.doc_id, r.term): r.weight for r in cells.collect()}
    dense = sum((x.get((d, t), 0.0) - sum(a * b for a, b in zip(w[d], h[t]))) ** 2 for d in w for t in h)
    assert math.isclose(topics.squared_error(cells, factors), dense, rel_tol=1e-9)


def test_topics_over_time_fit_their_bin(spark, cells):
    factors = topics.factorise(cells, topics=2, rounds=3)
    bins = spark.range(0, 40).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 20, 1).otherwise(2).alias("bin"))
    found = topics.topics_over_time(cells, factors, bins)
    assert found.filter("weight < 0 OR weight IS NULL").count() == 0
    assert rows(found.groupBy("bin").agg(F.countDistinct("topic"), F.countDistinct("term"))) == [(1, 2, 12), (2, 2, 12)]


def test_time_bins(spark):
    given = [(i, datetime(2024, 1, 1 + i), "x") for i in range(11)]
    corpus = spark.createDataFrame(given, "doc_id long, date timestamp, text string")
    found = {r.doc_id: r.bin for r in topics.time_bins(corpus).collect()}
    assert [found[i] for i in range(11)] == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10]
    single = topics.time_bins(corpus.limit(1))
    assert rows(single, "bin") == [(1,)]


def test_top_per_topic(spark):
    terms = spark.createDataFrame([(0, "a", 1.0), (0, "b", 2.0), (0, "c", 2.0), (1, "a", 0.5)], "topic int, term string, weight double")
    assert rows(topics.top_terms(terms, 2), "topic", "term", "rank") == [(0, "b", 1), (0, "c", 2), (1, "a", 1)]


def test_says_whether_it_converged(spark, cells):
    assert not topics.factorise(cells, topics=2, rounds=4).converged
    assert topics.factorise(cells, topics=2).converged
    nothing = topics.factorise(cells.limit(0), topics=2)
    assert nothing.converged and nothing.doc_topics.count() == nothing.topic_terms.count() == 0


def test_many_terms_move_no_cells_in_a_round(spark, cells, monkeypatch):
    """Factors of terms too many to be sent to all tasks are the same, and their cells are not dealt out again in each round."""
    few = topics.factorise(cells, topics=2, rounds=6)
    lookups = []
    monkeypatch.setattr(topics, "fits_broadcast", lambda *args: False)
    monkeypatch.setattr(topics, "lookup_join", lambda *args, **options: lookups.append(1) or joins.lookup_join(*args, **options))
    many = topics.factorise(cells, topics=2, rounds=6)
    assert len(lookups) == 1
    for left, right in ((few.doc_topics, many.doc_topics), (few.topic_terms, many.topic_terms)):
        for (key, x), (other, y) in zip(rows(left), rows(right)):
            assert key == other and all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(x, y))


def test_stored_messages_are_a_file_per_so_many(spark, sf, monkeypatch):
    """All messages went through one task, to one file."""
    whole = rows(queries.QUERIES["topic_corpus_scan"](spark, sf))
    written = []
    monkeypatch.setattr(queries, "STORED_FILE", 50)
    monkeypatch.setattr(queries, "write_csv", lambda df, path: written.append(df.rdd.getNumPartitions()) or files.write_csv(df, path))
    monkeypatch.setattr(queries.fixtures, "messages", lambda spark, sf_dir: messages(spark, sf_dir).repartition(8))
    assert rows(queries.QUERIES["topic_corpus_scan"](spark, sf)) == whole
    assert written == [4]


def test_word_counts_are_taken_by_tasks_of_a_bounded_number_of_documents(spark, monkeypatch):
    corpus = spark.range(40).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "aa bb cc").otherwise("dd ee ff").alias("text")).coalesce(1)
    widths = []
    monkeypatch.setattr(topics, "TASK_DOCS", 5)
    monkeypatch.setattr(topics, "stage", lambda df: widths.append(df.rdd.getNumPartitions()) or session.stage(df))
    found = topics.lda_topics(corpus, topics=2, n=3)
    assert widths == [8] and found.count() == 6
    assert {r.term for r in found.collect()} <= {"aa", "bb", "cc", "dd", "ee", "ff"}


def test_vector_keywords_of_some_buckets_at_a_time(spark, monkeypatch):
    """All documents went to all buckets at once, which grows with documents times buckets, and all shuffles stayed."""
    numbers = spark.range(60).withColumn("x", F.col("id").cast("float"))
    one = F.lit(1.0).cast("float")
    docs = numbers.select(F.col("id").alias("doc_id"), F.array(F.col("x"), one).alias("doc_vector"))
    words = numbers.select(F.concat(F.lit("t"), "id").alias("term"), F.array(one, F.col("x") - 30).alias("term_vector"))
    terms = docs.crossJoin(words).select("doc_id", "term").filter(F.xxhash64("doc_id", "term") % 3 != 0)
    whole = rows(topics.vector_keywords(terms, docs, words))
    tasks = []
    plain = cosines.nearest_in_buckets
    monkeypatch.setattr(cosines, "nearest_in_buckets", lambda *given: tasks.append(given[-2:]) or plain(*given))
    monkeypatch.setattr(cosines, "TASK_TERMS", 5)
    monkeypatch.setattr(cosines, "PASS_ROWS", 301)
    assert rows(topics.vector_keywords(terms, docs, words)) == whole and len(whole) == 300
    monkeypatch.setattr(topics, "SENT_TERMS", 59)
    assert rows(topics.vector_keywords(terms, docs, words)) == whole
    assert tasks == [(5, True)] * 3 + [(5, False)] * 3


@pytest.mark.parametrize("buckets", [1, 3, 7, 8, 61])
def test_lists_of_terms_are_packed_by_place(spark, buckets):
    """A term took eight bytes in each list."""
    terms = spark.range(30).select(F.col("id").alias("doc_id"), F.explode(F.sequence(F.lit(0), F.col("id") * 40)).alias("t")).select("doc_id", F.concat(F.lit("t"), "t").alias("term"))
    hashed = cosines.hashed_terms(spark.range(0, 1000, 2).select(F.concat(F.lit("t"), "id").alias("term")), buckets)
    of_bucket = {}
    for r in hashed.collect():
        of_bucket.setdefault(r.bucket, []).append((r.hash, r.term))
    found = cosines.packed_terms(terms, buckets, cosines.sent_terms(hashed)).collect()
    read = set()
    for r in found:
        places, sizes = cosines.ranks([bytes(r.hashes)])
        read |= {(r.doc_id, sorted(of_bucket[r.bucket])[i][1]) for i in places}
        assert sizes.tolist() == [len(places)]
    assert read == {(d, f"t{t}") for d in range(30) for t in range(0, min(d * 40 + 1, 1000), 2)}
    assert sum(len(r.hashes) for r in found) < 2 * len(read) + 2 * len(found)


def test_numbers_are_read_as_they_were_packed():
    x = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**28, 2**35, 2**40, 0])
    raw, ends = cosines.varints(x)
    cuts = [0, *ends[[2, 3, 10]]]
    places, sizes = cosines.ranks([raw[i:j].tobytes() for i, j in zip(cuts, cuts[1:])])
    assert sizes.tolist() == [3, 1, 7] and places.tolist() == [*np.cumsum(x[:3]), 128, *np.cumsum(x[4:])]
    assert cosines.ranks([])[0].tolist() == []


def test_staged_tables_let_go_of_their_shuffles(spark, tmp_path):
    """The files of each shuffle stayed until the driver happened to collect its garbage."""

    def files():
        return {f for top in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs() for f in glob.glob(f"{top}/*/shuffle_*")}

    before = files()
    df = spark.range(1000).repartition(3, "id")
    kept = session.stage(df), session.stored(df.withColumn("k", F.col("id") % 2), "kept", "k")
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before
    assert [table.count() for table in kept] == [1000, 1000] and df.count() == 1000
    assert spark.conf.get(session.STORING, "false") == "false"
