"""Languages, archives, decontamination and the pipeline."""

import base64
import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from driftline.llm import decontaminate, langid, queries, warc
from driftline.llm.shingles import word_hashes
from driftline.session import working_path
from .conftest import texts


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op4_langid(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    (right, low, high), total = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first(), got.count()
    assert total == 1000 and right > 0.97 and 0 <= low and high <= 1


def test_language_edges(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, "der Hund und die Katze", "de"), (4, None, "en"), (5, "77 !", "en"), (6, "el gato", None)]
    docs = spark.createDataFrame(rows * 3, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    model = langid.fit(docs)
    assert sorted(lang for duels in model.within.values() for lang in duels.names) == ["de", "en", "fr"]
    asked = [(1, "the cat"), (1, "the cat"), (2, None), (None, ""), (4, "123 -- 😀"), (5, "le chien " * 5000), (6, "\0a")]
    got = sorted(map(tuple, langid.predict(texts(spark, asked), model, keep=["doc_id", "text", "words"], lang_name="found", score_name="sure").collect()), key=str)
    assert len(got) == len(asked)
    for _, text, words, found, sure in got:
        assert words == "x" and (found == "und") == (not any(c.isalpha() for c in text or "")) and 0 <= sure <= 1
    assert {r[3] for r in got if r[0] == 5} == {"fr"}
    untaught = langid.fit(docs.filter("lang = 'xx'"))
    assert {r.lang_pred for r in langid.predict(texts(spark, asked), untaught, keep=["doc_id"]).collect()} == {"und"}
    alone = langid.fit(docs.filter("lang = 'fr'"))
    assert {r.lang_pred for r in langid.predict(texts(spark, [(1, "abc")]), alone, keep=["doc_id"]).collect()} == {"fr"}


def test_every_label_is_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "_fit_duels", lambda sample, label, names: langid.Duels(names))
    rows = [(i, "some words", f"l{i % 230:03}") for i in range(460)] + [(999, "a word", "rare")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(lang for duels in model.within.values() for lang in duels.names) == [*(f"l{i:03}" for i in range(230)), "rare"]


def expected_records(rows, least=0):
    largest = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        largest[payload] = max(largest.get(payload, (False, 0)), (page is not None, page or 0))
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        first = len(payload) < least or largest[payload] == (page is not None, page or 0)
        out.append((page, len(payload), digest, "response" if first else "revisit", None if first else largest[payload][1]))
    return sorted(out, key=str)


def test_archives(spark):
    rng = random.Random(8)
    bodies = [None, "", "<p>é</p>", "x\r\n\r\nWARC/1.1\r\n", *("".join(rng.choice("ab\n😀") for _ in range(n)) for n in (1, 50, 3000))]
    urls = [None, "", "http://A.example.com:80/x y\r\n?q#f", "https://a.example.com/", "no host", "http://[bad", "http://h/é", *[f"http://big.host/{i}" for i in range(40)]]
    rows = [(rng.choice([i, i, i, None, -i]), rng.choice(urls), rng.choice(bodies)) for i in range(300)] + [(7, urls[3], "same"), (7, urls[3], "same")]
    pages = spark.createDataFrame([(*row, "k", 1) for row in rows], "page_id long, url string, html string, key string, offset long").repartition(3)
    for least in (0, 10):
        folder = working_path(spark, "archives")
        captures = warc.write_archives(pages, folder, min_bytes=least, archive_bytes=4000)
        files = warc.write_index(captures, folder, block_lines=7)
        assert captures.count() == len(rows)
        found = warc.read_records(warc.locate(warc.page_keys(pages), folder, files), folder)
        got = found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert sorted(map(tuple, got), key=str) == expected_records(rows, least)
    one = warc.lookup(spark, folder, files, [urls[3], "http://not.there/"]).collect()
    assert len(one) == sum(warc.url_key(url) == warc.url_key(urls[3]) for _, url, _ in rows)
    assert warc.url_key("http://www.example.com:8080/a?b#c") == "com,example,www:8080)/a?b"


def test_no_pages(spark):
    pages, folder = spark.createDataFrame([], "page_id long, url string, html string"), working_path(spark, "archives")
    files = warc.write_index(warc.write_archives(pages, folder), folder)
    assert warc.read_records(warc.locate(warc.page_keys(pages), folder, files), folder).count() == 0


def test_op5_on_pages(spark, sf):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert sorted(map(tuple, queries.op5_warc(spark, sf).collect()), key=str) == expected_records(rows)


def brute_align(item, passage):
    table = np.zeros((len(item) + 1, len(passage) + 1))
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            step = decontaminate.MATCH if a == b else decontaminate.MISMATCH
            table[i, j] = max(0, table[i - 1, j - 1] + step, table[i - 1, j] + decontaminate.GAP, table[i, j - 1] + decontaminate.GAP)
    return table.max() / (decontaminate.MATCH * len(item))


def test_alignment():
    rng = random.Random(3)
    for _ in range(200):
        item, passage = ([rng.choice("abcd") for _ in range(n)] for n in (rng.randrange(1, 15), rng.randrange(0, 25)))
        hashed = [word_hashes(side) for side in (item, passage)]
        assert decontaminate.align(*hashed) == brute_align(item, passage)


def test_edited_copies(spark):
    rng = random.Random(9)
    items = [(i, " ".join(f"w{rng.randrange(4000)}" for _ in range(rng.randrange(20, 45)))) for i in range(12)] + [(50, "too short"), (51, None), (52, "a b c d e")]
    filler = lambda n: " ".join(f"f{rng.randrange(3000)}" for _ in range(n))
    rows, planted = [], set()
    for doc in range(60):
        number, text = items[rng.randrange(12)]
        words = text.split()
        kind = doc % 4
        if kind == 1:
            words[len(words) // 2] = "changed"
        elif kind == 2:
            words.insert(len(words) // 3, "more")
            del words[-2]
        if kind == 3:
            rows.append((doc, filler(80)))
        else:
            planted.add((doc, number))
            rows.append((doc, filler(30) + " " + " ".join(words).upper() + ", " + filler(200)))
    rows += [(100, None), (101, ""), (102, "too short"), (103, "A b, c d e!"), (0, rows[0][1])]
    planted.add((103, 52))
    docs = texts(spark, rows)
    table = spark.createDataFrame([(*row, 1) for row in items], "item_id long, text string, score int")
    for block in (100, 5):
        got = decontaminate.find(docs, table, block_items=block).collect()
        assert {(r.doc_id, r.item_id) for r in got} == planted
        assert sum(r.doc_id == 0 for r in got) == 2 and all(0.6 <= r.score <= 1 for r in got)
    clean = decontaminate.without_items(docs, table)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, _ in rows if d not in {p for p, _ in planted})
    assert decontaminate.find(docs, table.filter("false")).count() == 0
    assert decontaminate.find(texts(spark, []), table).count() == 0


def edited(rng, text, every):
    """A copy with a word replaced, left out or added after every ``every`` words."""
    out, words = [], text.split()
    for at, word in enumerate(words, 1):
        kind = rng.choice(("replace", "replace", "drop", "add")) if at % every == 0 else None
        out += {"replace": ["other"], "drop": [], "add": [word, "more"], None: [word]}[kind]
    return " ".join(out)


def test_densely_edited_copies(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words[:12] if rng.random() < 0.3 else words) for _ in range(n))) for i, n in enumerate([5, 6, 8, 11, 14, 20, 20, 27, 33, 45])]
    filler = lambda n: " ".join(rng.choice(words[:12]) for _ in range(n))
    # An exact copy of every item makes the edited ones hard to find by what is frequent.
    rows = [(100 + i, text) for i, text in items]
    rows += [(1000 + 10 * i + every, f"{filler(40)} {edited(rng, text, every)} {filler(70)}") for i, text in items for every in (2, 3, 4, 5, 6, 7)]
    twenty = items[5][1].split()
    twenty[6] = twenty[13] = "other"
    rows.append((1, " ".join(twenty)))
    docs, table = texts(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    for least in (0.6, 0.5, 0.75):
        aligned = {(doc, item): decontaminate.align(decontaminate.hashed_words(passage), decontaminate.hashed_words(text)) for doc, text in rows for item, passage in items}
        expected = {pair: round(score, 6) for pair, score in aligned.items() if score >= least}
        got = {(r.doc_id, r.item_id): r.score for r in decontaminate.find(docs, table, min_score=least).collect()}
        assert got == expected
        assert least > 0.6 or {(1000 + 10 * i + every, i) for i in range(4, 10) for every in (5, 6, 7)} | {(1, 5)} <= set(got)


def test_op3_finds_whole_items(spark, sf):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    whole = {(doc, item) for doc, text in docs for item, passage in items if passage in text}
    assert whole <= {(r.doc_id, r.item_id) for r in queries.op3_decontaminate(spark, sf).collect()}


def test_pipeline(spark):
    rng = random.Random(1)
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    long = " ".join(f"k{rng.randrange(9999)}" for _ in range(200))
    odd = [(9001, None), (9002, ""), (9003, "12 34"), (9004, long), (9005, long + " end"), (9006, f"so {item} then"), (9007, "mail me: a@b.cc now"), (None, "no id here")]
    docs = docs.unionByName(spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in odd], docs.schema))
    from driftline.llm.files import kept

    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, kept(stage(spark, docs, sf), "stage")
        seen[name] = {r.doc_id: r for r in docs.collect()}
        assert name == "tokens" or docs.schema.simpleString() == before.schema.simpleString()
    assert not {9001, 9002, 9003} & set(seen["language"]) and {9004, None} <= set(seen["language"])
    assert 9005 not in seen["near copies"] and 9004 in seen["near copies"] and None in seen["near copies"]
    assert 9006 in seen["near copies"] and 9006 not in seen["benchmark"] and 9007 in seen["benchmark"]
    assert seen["personal"][9007].text == "mail me: [EMAIL] now" and seen["personal"][9007].n_chars == 20
    assert set(seen["tokens"]) == set(seen["personal"])


def test_no_language_to_learn_from(spark):
    rows = [(1, "the cat and the dog"), (2, "der Hund"), (3, "12 -- 34"), (4, None), (5, ""), (None, "no id"), (6, "😀 5 é"), (6, "7 𝒳")]
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    for lang in (lambda i: None, lambda i: "en" if i is None else None):
        docs = spark.createDataFrame([(i, t, lang(i), "s", len(t or "")) for i, t in rows], kinds)
        kept = corpus_pipeline.language(spark, docs, "")
        assert kept.columns == docs.columns
        assert sorted(map(str, kept.collect())) == sorted(str(r) for r in docs.collect() if any(c.isalpha() for c in r.text or ""))


def test_pipeline_of_nothing(spark):
    empty = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "/root/testdata/sf0.001")
    assert empty.count() == 0
