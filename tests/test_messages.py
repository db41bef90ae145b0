import random
import time
from datetime import datetime

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from driftline.functions.stopwords import stop_words
from driftline.operators import messages
from driftline.operators.joins import lookup_join
from driftline.operators.ranking import global_rank, top_n_per_key, top_n_wide
from driftline.queries import QUERIES
from driftline.sources import fixtures


def posts(spark, *given):
    """(channel, id, day, text)"""
    filled = [(c, i, datetime(2024, 1, day), text, None, i, False, None) for c, i, day, text in given]
    schema = "channel_username string, message_id long, date timestamp, text string, views long, forwards long, is_forwarded boolean, forward_from_chat string"
    return spark.createDataFrame(filled, schema)


def test_limit_counts_before_the_filters(spark):
    df = posts(spark, ("a", 1, 1, "x"), ("a", 2, 2, "x"), ("a", 3, 3, ""), ("a", 4, 4, "x"))
    kept = messages.collect_messages(df, limit=2, end="2024-01-03")
    assert rows(kept, "message_id") == []
    assert rows(messages.collect_messages(df, limit=3, end="2024-01-03"), "message_id", "views") == [(2, 0)]


def test_dates_are_inclusive(spark):
    df = posts(spark, ("a", 1, 1, "x"), ("a", 2, 2, "x"), ("a", 3, 3, "x"))
    assert rows(messages.messages_in_range(df, "2024-01-02", "2024-01-03"), "message_id") == [(2,), (3,)]
    assert messages.messages_in_range(df).count() == 3


def test_keywords_ignore_case_and_merge(spark):
    df = posts(spark, ("a", 1, 1, "Red fish"), ("a", 2, 2, "blue FISH"), ("b", 1, 1, "fish"), ("b", 2, 1, None))
    found = messages.keyword_posts(df, ["RED", "fish", ""], 10)
    assert rows(found, "channel_username", "message_id", "keyword") == sorted(
        [("a", 1, "RED"), ("a", 1, "fish"), ("a", 2, "fish"), ("b", 1, "fish"), ("a", 1, ""), ("a", 2, ""), ("b", 1, ""), ("b", 2, "")],
        key=str,
    )
    merged = messages.collect_messages(df, keywords=["RED", "fish", ""])
    assert rows(merged, "channel_username", "message_id") == [("a", 1), ("a", 2), ("b", 1)]


def test_last_read_copy_of_a_message_wins(spark):
    df = posts(spark, ("a", 1, 5, "newer"), ("a", 1, 2, "older"))
    assert rows(messages.collect_messages(df), "text") == [("older",)]
    assert rows(messages.collect_messages(df, limit=None), "text") == [("older",)]
    assert rows(messages.collect_messages(df, keywords=["older", "newer"]), "text") == [("newer",)]


def test_only_wanted_channels(spark):
    df = posts(spark, ("a", 1, 1, "x"), ("b", 1, 1, "x"))
    wanted = spark.createDataFrame([("b",)], "channel_username string")
    assert rows(messages.collect_messages(df, wanted), "channel_username") == [("b",)]


def test_channel_list_and_pending(spark):
    listed = messages.channel_list(spark.createDataFrame([("@a",), ("a",), ("@@b ",), (" ",), (None,)], "username string"))
    assert rows(listed) == [("a",), ("b",)]
    done = spark.createDataFrame([("@b", 3)], "channel_username string, messages_written long")
    assert rows(messages.pending_channels(listed, done)) == [("a",)]


def skewed(spark, n=3000):
    """A third of all rows under one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50)
    return spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("v"), F.xxhash64("id").alias("o"))


def test_top_n_of_a_hot_key(spark):
    df = skewed(spark)
    by_key = {}
    for row in df.collect():
        by_key.setdefault(row.k, []).append((row.o, row.v))
    expected = sorted((k, v, i + 1) for k, vs in by_key.items() for i, (_, v) in enumerate(sorted(vs, reverse=True)[:7]))
    narrow = top_n_per_key(df, ["k"], [F.desc("o")], 7, salts=3)
    wide = top_n_wide(df, ["k"], [F.col("o")], 7)
    assert sorted(map(tuple, narrow.select("k", "v", "rank").collect())) == expected
    assert sorted(map(tuple, wide.select("k", "v", "rank").collect())) == expected


def test_top_n_puts_nulls_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", None, 3), ("b", None, 4)], "k string, o long, v long")
    assert rows(top_n_wide(df, ["k"], [F.col("o"), F.col("v")], 2), "k", "v", "rank") == [("a", 2, 1), ("a", 3, 2), ("b", 4, 1)]


def test_both_ways_of_a_lookup_agree(spark):
    facts = skewed(spark)
    names = spark.range(0, 40).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        small = lookup_join(facts, names, "k", how)
        salted = lookup_join(facts, names, "k", how, max_rows=5, salts=4)
        assert "Broadcast" in small._jdf.queryExecution().simpleString()
        assert small.exceptAll(salted).count() == 0 and small.count() == salted.count()


def test_global_rank(spark):
    df = skewed(spark).select("v", (F.col("v") % 4).alias("f"))
    found = [(r.f, r.v) for r in global_rank(df, [F.desc("f"), F.asc("v")]).orderBy("rank").collect()]
    assert found == sorted(found, key=lambda t: (-t[0], t[1])) and len(found) == 3000
    ranks = [r.rank for r in global_rank(df, [F.desc("f"), F.asc("v")]).select("rank").collect()]
    assert sorted(ranks) == list(range(1, 3001))


def test_odd_channel_names(spark):
    given = spark.createDataFrame([("none",), ("@",), (" ",), (None,), ("@x",)], "username string")
    assert rows(messages.channel_list(given)) == [("none",), ("x",)]


@pytest.mark.parametrize("many", [1, 10**6])
def test_many_keywords_find_what_each_one_finds(spark, many):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abAB ßÉé漢😀") for _ in range(rng.choice([0, 1, 2, 3, 8, 40]))) for _ in range(80)] + [None, ""]
    words = ["", "a", "É", "aB", "ab ", "BA", "漢a", "abab", "not there", "aaa", "a b", "😀", "é漢ß", "abab", *(t[2:7] for t in texts if t and len(t) > 7)]
    df = posts(spark, *[("c", i, 1, t) for i, t in enumerate(texts)])
    found = messages.match_keywords(df, words, many=many)
    assert found.columns == [*df.columns, "keyword_no", "keyword"]
    expected = [(i, n) for i, t in enumerate(texts) for n, w in enumerate(words) if w.lower() in (t or "").lower()]
    assert sorted((r.message_id, r.keyword_no) for r in found.collect()) == sorted(expected)
    assert all(r.keyword == words[r.keyword_no] for r in found.collect())


def test_keywords_are_keyed_by_what_is_rare(spark):
    df = posts(spark, *[("c", i, 1, "the same words " + ("zebra" if i == 5 else "")) for i in range(20)]).withColumn("_text", F.col("text"))
    words = spark.createDataFrame([(0, "the zebra"), (1, "same"), (2, "quux")], "keyword_no int, word string")
    assert {r.word: r.key for r in messages.keyword_keys(df, words).collect()} == {"the zebra": "e z", "same": "ame", "quux": "quu"}


def test_many_keywords_in_a_long_text(spark):
    """Trigrams were cut out one by one, each counted from the begin of the text: quadratic in its length."""
    text = "".join(chr(0x430 + i * 7 % 31) + ("\n" if i % 9 == 0 else "") for i in range(1_000_000)) + " last\u00a0word end"
    df = posts(spark, ("c", 1, 1, text), ("c", 2, 1, "\t last \n"))
    words = ["last", "last word", "last\u00a0word", "t\u00a0w", "word end", "d", " ", "", *(f"none{i}" for i in range(70))]
    started = time.monotonic()
    found = sorted((r.message_id, r.keyword) for r in messages.match_keywords(df, words).collect())
    assert time.monotonic() - started < 60
    held = {1: ["last", "last\u00a0word", "t\u00a0w", "word end", "d", " ", ""], 2: ["last", " ", ""]}
    assert found == sorted((i, word) for i, kept in held.items() for word in kept)


def test_keyword_counts_look_for_every_stop_word(spark, sf):
    """Only the words of one list were looked for, of a language that no text is in."""
    texts = [(row.text or "").lower() for row in fixtures.messages(spark, sf).select("text").collect()]
    expected = {word: n for word in stop_words() if (n := sum(word in text for text in texts))}
    assert {row.keyword: row.posts for row in QUERIES["keyword_counts"](spark, sf).collect()} == expected
    assert {"the", "und", "les", "los"} <= set(expected)


def test_keywords_are_marked_in_parts(spark, monkeypatch):
    texts = [f"w{i} w{i % 7} the w{i}" for i in range(50)] + [None, ""]
    words = ["", "the", "w1", "e w", *(f"w{i}" for i in range(2, 90))]
    monkeypatch.setattr(messages, "CELLS", 300)
    monkeypatch.setattr(messages, "WORDS_AT_A_TIME", 2)
    finder = messages.KeywordFinder([(i, word, word[:3] if len(word) > 2 else None) for i, word in enumerate(words)])
    found = finder(pa.array([text or "" for text in texts])).to_pylist()
    assert found == [[i for i, word in enumerate(words) if word in (text or "")] for text in texts]
