import math
import random
import re
from collections import Counter
from itertools import combinations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from driftline.functions.stopwords import NAME_LANGUAGES, stop_words
from driftline.functions.text import ngrams, tokens
from driftline.operators import names, textstats, vocabulary

TEXTS = ["The red fish", "the red fish", "Red red wine, more wine!", "один два", "a b", "", "The red fish", "über_2 straße"]
STOPS = ["the"]


def plain_terms(text):
    words = [w for w in re.findall(r"(?u)\b\w\w+\b", text.lower()) if w not in STOPS]
    return Counter(" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")


def test_tokens_and_ngrams(spark):
    cut = docs(spark).withColumn("w", tokens(F.col("text")))
    for row in cut.select("text", "w", ngrams(F.col("w"), 2, 3).alias("g")).collect():
        assert row.w == re.findall(r"(?u)\b\w\w+\b", row.text.lower())
        assert sorted(row.g) == sorted(" ".join(row.w[i : i + n]) for n in (2, 3) for i in range(len(row.w) - n + 1))


def test_doc_terms(spark):
    expected = sorted(((i, term, tf) for i, t in enumerate(TEXTS) for term, tf in plain_terms(t).items()), key=str)
    assert rows(vocabulary.doc_terms(docs(spark), ["doc_id"], stop_words=STOPS)) == expected


def test_vocabulary_bounds(spark):
    per_doc = [plain_terms(t) for t in TEXTS]
    df = Counter(term for terms in per_doc for term in terms)
    total = sum(per_doc, Counter())
    n = docs(spark).agg(F.count("text")).scalar()
    found = vocabulary.vocabulary(docs(spark), n, stop_words=STOPS, min_df=2, max_df=0.5)
    assert rows(found) == sorted(((t, df[t], total[t]) for t in df if 2 <= df[t] <= 0.5 * len(TEXTS)), key=str)
    # 0.3 of 8 documents is 2.4, not rounded
    found = vocabulary.vocabulary(docs(spark), n, stop_words=STOPS, min_df=0.3)
    assert rows(found, "term") == sorted(((t,) for t in df if df[t] >= 2.4), key=str)


def test_copies_weigh_like_repeated_documents(spark):
    texts = vocabulary.distinct_texts(docs(spark), "text")
    n = texts.agg(F.sum("copies")).scalar()
    once = vocabulary.vocabulary(texts, n, stop_words=STOPS, min_df=2)
    n = docs(spark).agg(F.count("text")).scalar()
    assert rows(once) == rows(vocabulary.vocabulary(docs(spark), n, stop_words=STOPS, min_df=2))


def test_cooccurrence(spark):
    expected = Counter()
    for text in TEXTS:
        terms = plain_terms(text)
        for a, b in combinations(sorted(terms), 2):
            expected[a, b] += terms[a] * terms[b]
            expected[b, a] += terms[a] * terms[b]
    texts = vocabulary.distinct_texts(docs(spark), "text")
    found = vocabulary.cooccurrence(vocabulary.text_terms(texts, stop_words=STOPS))
    assert {(r.a, r.b): r.weight for r in found.collect()} == dict(expected)
    plain = vocabulary.cooccurrence(vocabulary.doc_terms(docs(spark), ["doc_id"], stop_words=STOPS))
    assert rows(found) == rows(plain)


def test_word_graph_keeps_isolated_terms(spark):
    vocab = spark.createDataFrame([("x", 1, 1), ("y", 1, 1), ("z", 1, 1)], "term string, df long, frequency long")
    pairs = spark.createDataFrame([("x", "y", 2), ("y", "x", 2)], "a string, b string, weight long")
    assert rows(vocabulary.word_graph(vocab, pairs)) == [("x", "y", 2), ("y", "x", 2), ("z", None, None)]


def test_terms_within_a_vocabulary(spark):
    vocab = spark.createDataFrame([("red",), ("red fish",)], "term string")
    found = vocabulary.doc_terms(docs(spark), ["doc_id"], stop_words=STOPS, within=vocab)
    assert rows(found.groupBy("term").agg(F.sum("tf"))) == [("red fish", 3), ("red", 5)]


def test_a_large_vocabulary_gives_the_same_terms(spark, monkeypatch):
    vocab = spark.createDataFrame([("red", 1.5), ("red fish", 2.5)], "term string, idf double")
    small = rows(vocabulary.doc_terms(docs(spark), ["doc_id"], stop_words=STOPS, within=vocab), "doc_id", "term", "idf", "tf")
    monkeypatch.setattr(vocabulary, "fits_broadcast", lambda df: False)
    large = rows(vocabulary.doc_terms(docs(spark), ["doc_id"], stop_words=STOPS, within=vocab), "doc_id", "term", "idf", "tf")
    assert small == large and len(small) == 7


def test_stop_words(spark):
    words = stop_words()
    assert words == sorted(set(words)) and len(words) > len(stop_words(["italian"])) > 200
    assert {"il", "the", "und", "les", "los", "его"} <= set(words) and len(NAME_LANGUAGES) == 6


def test_name_table_drops_blank_titles(spark):
    channels = spark.createDataFrame(
        [(1, "a", "A b", "f"), (1, "a", "A b", "f"), (2, "b", None, "f"), (3, "c", "  ", "f")],
        "channel_id long, username string, title string, source_file string",
    )
    assert rows(names.name_table(channels)) == [(1, "A b", "f", "title"), (1, "A b", "f", "title")]


def test_features_and_stats(spark):
    table = spark.createDataFrame([("Il Post",), ("Avvenire",), ("L'Eco di Bergamo",)], "name string")
    features = names.name_features(table)
    assert rows(features) == [("L'Eco di Bergamo", 4, 16, True), ("Avvenire", 1, 8, False), ("Il Post", 2, 7, True)]
    stats = dict(rows(names.length_stats(features)))
    assert math.isclose(stats["avg_words_per_name"], 7 / 3)
    assert math.isclose(stats["pct_names_with_article_or_preposition"], 2 / 3)


def test_histogram(spark):
    values = spark.createDataFrame([(v,) for v in [0, 1, 1, 5, 10]], "v int")
    found = names.length_histogram(values, ["v"], bins=5).orderBy("bin").collect()
    assert [r.n for r in found] == [3, 0, 1, 0, 1] and found[0].lower == 0 and found[-1].upper == 10
    flat = names.length_histogram(values.select(F.lit(3).alias("v")), ["v"], bins=2).orderBy("bin").collect()
    assert [(r.lower, r.upper, r.n) for r in flat] == [(2.5, 3.0, 0), (3.0, 3.5, 5)]


def test_zipf_of_an_exact_power_law(spark):
    freq = spark.createDataFrame([(f"w{r:03d}", 27720 // r) for r in (1, 2, 3, 4, 5, 6)], "word string, frequency long")
    fit = names.zipf_fit(names.zipf_table(freq)).first()
    assert math.isclose(fit.slope, -1.0, abs_tol=1e-9) and math.isclose(fit.intercept, math.log(27720), abs_tol=1e-9)


def test_readability(spark):
    df = spark.createDataFrame([("a", 1, "Uno due. Tre!  ..."), ("a", 2, ""), ("a", 3, None)], "channel_username string, message_id int, text string")
    lengths = textstats.text_lengths(df)
    assert rows(lengths) == [("a", 1, 3, 18, 2, 9), ("a", 2, 0, 0, 0, 0)]
    assert rows(textstats.gulpease(lengths)) == [("a", 1, 89 + (300 * 2 - 10 * 9) / 3), ("a", 2, None)]
    assert rows(textstats.sentence_length(lengths), "words_per_sentence") == [(1.5,), (None,)]
    assert rows(textstats.letters_per_word(lengths), "letters_per_word") == [(3.0,), (None,)]


@pytest.mark.parametrize("block", [1, 2, 7, 64, 1000])
def test_blocks_of_terms_give_all_pairs(spark, block):
    rng = random.Random(block)
    counts = {d: {f"t{rng.randrange(40):02}": rng.randint(1, 3) for _ in range(rng.choice([0, 1, 5, 30]))} for d in range(12)}
    counts[12] = counts[11]
    terms = spark.createDataFrame([(d, t, n) for d, found in counts.items() for t, n in found.items()], "doc_id long, term string, tf long")
    expected = {}
    for found in counts.values():
        for a in found:
            for b in found:
                if a != b:
                    expected[a, b] = expected.get((a, b), 0) + found[a] * found[b]
    got = vocabulary.cooccurrence(terms, block=block).collect()
    assert {(r.a, r.b): r.weight for r in got} == expected and len(got) == len(expected)


def test_a_long_text_is_shared_by_all_tasks(spark):
    lists = spark.range(1).select(F.lit(1).alias("n"), F.transform(F.sequence(F.lit(1), F.lit(20_000)), lambda i: F.struct(i.cast("string").alias("term"), F.lit(1).alias("tf"))).alias("terms"))
    units = vocabulary.pair_units(lists, 256)
    work = F.when(F.col("same"), F.size("left") * (F.size("left") - 1) / 2).otherwise(F.size("left") * F.size("right"))
    sizes = sorted(r.pairs for r in units.groupBy(F.spark_partition_id()).agg(F.sum(work).alias("pairs")).collect())
    assert sum(sizes) == 20_000 * 19_999 / 2 and len(sizes) == 4 and sizes[-1] < 1.5 * sizes[len(sizes) // 2]
