"""Sequences of documents: whole, without a gap, few, and chosen by sums of squares."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftline.llm import packing, queries
from driftline.llm.words import load_tokenizer

from .conftest import texts

BYTE, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def stored(tmp_path, spark, rows):
    texts(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def gapless(result, capacity):
    """Lengths of the sequences, each without a gap from its begin on."""
    filled = {}
    for row in sorted(result, key=lambda row: row.offset):
        assert row.offset == filled.get(row.sequence_id, 0) and row.length > 0
        filled[row.sequence_id] = row.offset + row.length
    assert all(length <= capacity for length in filled.values())
    return filled


def corpus(n):
    rng = random.Random(n)
    words = "the of rain sea 12 é 漢 stone".split()
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([0, 3, 40, 200, 700, 1000, 2500])))) for i in range(n)]
    return rows + [(3, "again"), (3, "again"), (None, "no id"), (None, None), (8, "x" * 30000), (n, ""), (n + 1, "<|endoftext|> a")]


def test_pieces_are_whole_documents(spark, tmp_path):
    rows = corpus(60)
    result = queries.op13_packing(spark, stored(tmp_path, spark, rows)).collect()
    tokenizer = load_tokenizer(BYTE)
    expected = []
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at, number = 0, 0
        while at < len(ids):
            end = at + 1024 if (len(ids) - at) % 1024 == 0 else at + (len(ids) - at) % 1024
            expected.append((doc, number, at, end - at, zlib.crc32(ids[at:end].tobytes())))
            at, number = end, number + 1
    assert sorted(map(str, [tuple(row)[:5] for row in result])) == sorted(map(str, expected))
    gapless(result, 1024)


@pytest.mark.parametrize("length, bounds", [(0, [0]), (1, [0, 1]), (4, [0, 4]), (5, [0, 1, 5]), (8, [0, 4, 8]), (11, [0, 3, 7, 11])])
def test_cuts(length, bounds):
    assert packing.cuts(length, 4) == bounds


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=60), st.integers(12, 15))
def test_every_place_has_the_least_sum_of_squares(lengths, capacity):
    opened, levels = packing.Open(capacity), []

    def total(levels):
        return sum(levels.count(level) ** 2 for level in set(levels) if level < capacity)

    for length in lengths:
        number, offset = opened.place(length)
        fits = [i for i, level in enumerate(levels) if level + length <= capacity]
        if not fits:
            assert (number, offset) == (len(levels), 0)
            levels.append(length)
            continue
        assert number in fits and offset == levels[number]
        after = {i: total([level + length * (i == j) for j, level in enumerate(levels)]) for i in fits}
        least = min(after.values())
        assert after[number] == least and offset == max(levels[i] for i in fits if after[i] == least)
        levels[number] += length


def numbers(spark, lengths):
    rows = [(i, None, 0, 0, length, 0) for i, length in enumerate(lengths)]
    return spark.createDataFrame(rows, packing.PIECES)


@pytest.mark.parametrize("share", [200, 800, 10_000])
def test_few_sequences_however_many_shares(spark, share):
    rng = random.Random(share)
    lengths = [rng.choice([rng.randint(1, 1024), rng.randint(1, 100), 333, 512, 1024]) for _ in range(3000)]
    result = packing.pack(numbers(spark, lengths), share=share).collect()
    assert sorted(row.key for row in result) == list(range(3000))
    filled = gapless(result, 1024)
    levels = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, level in enumerate(levels) if level + length <= 1024]
        best = max(fits, key=levels.__getitem__, default=None)
        if best is None:
            levels.append(length)
        else:
            levels[best] += length
    assert len(filled) <= 1.01 * len(levels)


def test_halves_are_paired_whatever_the_shares(spark):
    filled = gapless(packing.pack(numbers(spark, [512] * 999), share=100).collect(), 1024)
    assert len(filled) == 500


def test_sequences_hold_the_ids(spark):
    made = packing.pieces(texts(spark, corpus(40)), BYTE, RANKS, capacity=64, end_id=2, with_ids=True)
    placed = packing.pack(made, capacity=64)
    assert "ids" not in placed.columns
    parts = {(row.sequence_id, row.offset): row for row in placed.collect()}
    for row in packing.sequences(made, placed).collect():
        for doc, at, end in zip(row.doc_ids, row.offsets, [*row.offsets[1:], len(row.ids)]):
            piece = parts.pop((row.sequence_id, at))
            assert piece.doc_id == doc and piece.length == end - at
            assert piece.ids_crc32 == zlib.crc32(np.array(row.ids[at:end], "<u4").tobytes())
    assert not parts


def test_no_documents(spark, tmp_path):
    result = queries.op13_packing(spark, stored(tmp_path, spark, []))
    assert result.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and result.count() == 0
    without_end = packing.pieces(texts(spark, [(1, ""), (2, None)]), BYTE, RANKS)
    assert packing.pack(without_end).count() == 0
