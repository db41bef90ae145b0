"""Encoding, decoding, counts per section and code files against the tokenizers library."""

import hashlib
import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftline.llm import bpe, codes, counts, queries
from driftline.llm.words import ByteWords, WordEnds, load_tokenizer
from driftline.session import working_path
from .conftest import texts

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = ["a", "b", "the", "'s", "'", "!", "<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "é", "é", "́", "İ", "12"]
PARTS += ["漢", "😀", "ß", "\x1c", "\xa0", "\x85", "Σ", "th", "ᄀ", "ᅡ", "<|", "|>", "\t", "　", "​"]
ODD = [None, "", " ", "\n\n", "x" * 3000, "ab" * 2500, "The end. " * 400, "<|endoftext|> " * 50, "é" * 1500, "!'s" * 900]


@pytest.fixture(scope="module")
def word():
    return WordEnds(WORD)


@pytest.fixture(scope="module")
def byte():
    return ByteWords(BYTE, RANKS)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS) | st.text(st.characters(min_codepoint=0x20, max_codepoint=0x180), max_size=6), max_size=40), max_size=5))
def test_words_looked_up_together(byte, parts):
    texts = ["".join(part) for part in parts]
    got = ByteWords.encode_all(byte, texts)
    assert [ids.tolist() for ids in got] == [byte.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]


def test_memory_of_words_is_bounded(byte, monkeypatch):
    monkeypatch.setattr("driftline.llm.words.MAX_WORDS", 50)
    for at in range(20):
        text = " ".join(f"word{at * 7 + k}" for k in range(30))
        assert byte.encode_all([text])[0].tolist() == byte.tokenizer.encode(text, add_special_tokens=False).ids and len(byte) <= 80


def tree(word, text, leaf):
    bounds = bpe.leaf_bounds(len(text), leaf)
    return bpe.concatenate_tree(word, text, [bpe.encode_leaf(word, text, a, b) for a, b in zip(bounds, bounds[1:])])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=300), st.sampled_from([1, 7, 40, 200]))
def test_tree_is_the_whole_encoding(word, parts, leaf):
    text = "".join(parts)
    assert tree(word, text, leaf).tolist() == word.tokenizer.encode(text, add_special_tokens=False).ids


def test_tree_over_unsplit_texts(word):
    rng = random.Random(4)
    for letters in ("ab", "abcdef", "thea", "!?'", "12a", "é漢a"):
        text = "".join(rng.choice(letters) for _ in range(4000))
        assert tree(word, text, 300).tolist() == word.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(min_codepoint=0x21, max_codepoint=0x180) | st.sampled_from("the'sradin"), min_size=1, max_size=25))
def test_plain_words_by_ranks(word, text):
    assert word.merge and word.encode([text])[0].tolist() == word.tokenizer.encode(text, add_special_tokens=False).ids


def test_ranks_only_for_their_kind_of_tokenizer():
    assert WordEnds(BYTE).merge is None


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=60))
def test_byte_words(byte, parts):
    text = "".join(parts)
    coded = byte.tokenizer.encode(text, add_special_tokens=False)
    assert byte.encode(text).tolist() == coded.ids
    ids, starts, ends = counts.token_spans(byte, byte.chars_per_id(), text)
    whole = [(a, b) for a, b in coded.offsets]
    assert [(a, b) for a, b in zip(starts.tolist(), ends.tolist()) if b > a] == [(a, b) for (a, b), s, e in zip(whole, starts, ends) if e > s]


def test_encode_and_decode(spark):
    rows = [(i, text) for i, text in enumerate(ODD)] + [(3, ODD[4]), (None, "no id"), (None, "no id")]
    decoded = bpe.decode(bpe.encode(texts(spark, rows), WORD, leaf_chars=500), WORD)
    tokenizer = load_tokenizer(WORD)

    def expected(text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        return ids, tokenizer.decode(ids, skip_special_tokens=False)

    assert sorted(map(str, decoded.collect())) == sorted(str(row) for row in _rows(decoded, [(i, *expected(t)) for i, t in rows]))


def _rows(df, values):
    from pyspark.sql import Row

    return [Row(**dict(zip(df.columns, value))) for value in values]


def test_no_documents(spark):
    empty = texts(spark, [])
    assert bpe.decode(bpe.encode(empty, WORD), WORD).count() == 0
    assert counts.attribute(empty, BYTE, RANKS).count() == 0
    folder = working_path(spark, "empty")
    assert codes.read_codes(spark, folder, codes.write_codes(empty, folder, BYTE, RANKS)).count() == 0


def test_op1_on_documents(spark, sf):
    tokenizer = load_tokenizer(WORD)
    got = {row.doc_id: tuple(row)[1:] for row in queries.op1_bpe(spark, sf).collect()}
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = tokenizer.encode(row.text, add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        sums = [hashlib.sha256(part.encode()).hexdigest() for part in (" ".join(map(str, ids)), text)]
        assert got[row.doc_id] == (len(ids), *sums)


def test_op9_on_documents(spark, sf):
    tokenizer, start, got = load_tokenizer(BYTE), 0, {row.doc_id: tuple(row)[1:] for row in queries.op9_codes(spark, sf).collect()}
    for row in sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda row: row.doc_id):
        ids = [*tokenizer.encode(row.text, add_special_tokens=False).ids, queries.END_ID]
        assert got[row.doc_id] == (start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes()))
        start += len(ids)


def test_code_file_gives_any_token():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 1 << bits, 900) for bits in (3, 8, 9, 17, 31)]).astype(np.uint32)
    rng.shuffle(ids)
    lists = [ids[:0], ids[:1700], ids[1700:1700], ids[1700:]]
    out = io.BytesIO()
    codes.write_file(out, [None, -4, 7, 9], lists)
    found = codes.CodeFile(out)
    assert found.documents()[0] == [None, -4, 7, 9] and found.documents()[1].tolist() == [0, 0, 1700, 1700, len(ids)]
    assert [found.token(i) for i in range(0, len(ids), 7)] == ids[::7].tolist()
    for a, b in ((0, len(ids)), (511, 513), (512, 1024), (8, 8), (4499, 4500)):
        assert np.array_equal(found.slice(a, b), ids[a:b])
    with pytest.raises(IndexError):
        found.token(len(ids))


def test_codes_with_odd_rows(spark):
    rows = [(i, text) for i, text in enumerate(ODD)] + [(2, "again"), (2, "again"), (None, "first")]
    folder = working_path(spark, "odd")
    files = codes.write_codes(texts(spark, rows).repartition(5), folder, BYTE, RANKS, end_id=2, file_tokens=500)
    assert files.count() > 1
    got = sorted(codes.read_codes(spark, folder, files).collect(), key=lambda row: row.start)
    tokenizer, start = load_tokenizer(BYTE), 0
    ordered = sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, row[1] or ""))
    for row, (doc, text) in zip(got, ordered, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert (row.doc_id, row.start, row.ids) == (doc, start, ids)
        start += len(ids)


def brute_section(spans, token, rule):
    a, b = token
    if rule != "overlap":
        at = a if rule == "start" else max(b - 1, a)
        return next((k for k, (x, y) in enumerate(spans) if x <= at < y), -1)
    covered = [min(y, max(b, a + 1)) - max(x, a) for x, y in spans]
    return covered.index(max(covered)) if covered and max(covered) > 0 else -1


@pytest.mark.parametrize("rule", counts.RULES)
def test_counts_per_section(spark, rule):
    spans = [(0, 3), (3, 4), (6, 20), (25, 400), (400, 5000)]
    cells = "array<struct<start:long,end:long>>"
    rows = [(i, text, spans) for i, text in enumerate(ODD + ["The quick brown fox jumps over 😀😀 lazy dogs."])] + [(99, "abc", None)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, start {cells}")
    got = {}
    for row in counts.attribute(docs, BYTE, RANKS, sections_col="start", rule=rule).collect():
        got[row.doc_id, row.section_no] = row.n_tokens
    byte, sizes = ByteWords(BYTE, RANKS), None
    for doc, text, sections in rows:
        sizes = sizes or byte.chars_per_id()
        _, starts, ends = counts.token_spans(byte, sizes, text or "")
        chosen = [brute_section(sections or [], token, rule) for token in zip(starts.tolist(), ends.tolist())]
        for k in range(-1, len(sections or [])):
            assert got.get((doc, k), 0) == chosen.count(k)


def test_lines_add_up(spark, sf):
    tokenizer = load_tokenizer(BYTE)
    got = {row.doc_id: row.n for row in queries.op8_token_counts(spark, sf).groupBy("doc_id").agg({"n_tokens": "sum"}).toDF("doc_id", "n").collect()}
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        assert got.get(row.doc_id, 0) == len(tokenizer.encode(row.text, add_special_tokens=False).ids)


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        counts.attribute(texts(spark, []), BYTE, RANKS, rule="any")
