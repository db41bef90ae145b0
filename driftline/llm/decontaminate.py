"""Test items in training texts: counted word pairs propose places, local alignment scores them.

Test items are a stated set of queries and go to the tasks in blocks of bounded
size; texts are read in place and never shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.shingles import in_use, runs, word_hashes

MIN_ITEM_WORDS = 5
MIN_SCORE = 0.6
BLOCK_ITEMS = 20_000
SLICE_WORDS = 20_000
# Bounds are worked in floating point.
ROUNDING = 1e-9

# Points of the alignment.
MATCH, MISMATCH, GAP = 2, -1, -1

_WORD = re.compile(r"\w+")


def hashed_words(text: str | None) -> np.ndarray:
    """Hashes of a text's words, letters and digits only, in lower case."""
    return word_hashes(_WORD.findall((text or "").lower()))


def align(item: np.ndarray, passage: np.ndarray) -> float:
    """Best local alignment (Smith-Waterman) as a share of what the item scores with itself."""
    steps = -GAP * np.arange(len(passage) + 1)
    above = np.zeros(len(passage) + 1, np.int64)
    best = 0
    for word in item:
        row = np.zeros(len(passage) + 1, np.int64)
        row[1:] = np.maximum(above[:-1] + np.where(passage == word, MATCH, MISMATCH), above[1:] + GAP)
        row = np.maximum(row, 0)
        # A gap in the item may be of any length: the best start so far, less one step per word.
        above = np.maximum.accumulate(row + steps) - steps
        best = max(best, int(above.max()))
    return best / (MATCH * len(item))


class Items:
    """A block of test items, their word pairs, and what any alignment of ``min_score`` or more must hold.

    In an item of n words, c changed, missing or added words leave a score of
    2m - c for m unchanged ones, in c + 1 runs at most. From 2m - c >= 2 n min_score
    follow m >= n min_score, c <= 2 n (1 - min_score) and at least
    n (2 min_score - 1) - 1 unchanged pairs. Where that is less than one pair,
    single words are counted instead, so no place is passed over.
    """

    def __init__(self, rows: list[tuple], min_score: float) -> None:
        self.ids = [row[0] for row in rows]
        self.words = [hashed_words(row[1]) for row in rows]
        sizes = np.array([len(words) for words in self.words])
        self.least_words = np.maximum(1, np.ceil(sizes * min_score - ROUNDING)).astype(np.int64)
        pairs = np.ceil(sizes * (2 * min_score - 1) - 1 - ROUNDING).astype(np.int64)
        self.need = np.where(pairs >= 1, pairs, self.least_words)
        self.slack = np.floor(2 * sizes * (1 - min_score) + ROUNDING).astype(np.int64)
        self.reach = sizes + self.slack
        self.sizes = sizes
        self.bags = [np.unique(words) for words in self.words]
        first, last = {}, {}
        searched = set()
        for number, words in enumerate(self.words):
            if len(words) < MIN_ITEM_WORDS:
                continue
            length = 2 if pairs[number] >= 1 else 1
            searched.add(length)
            for at, gram in enumerate(runs(words, length).tolist()):
                first.setdefault((gram, number), at)
                last[gram, number] = at
        self.lengths = sorted(searched)
        keys = sorted(first)
        # A row per n-gram and item, with its first and last place there, and where the rows of each n-gram begin.
        self.grams, self.begins = np.unique(np.array([gram for gram, _ in keys], np.uint64), return_index=True)
        self.begins = np.append(self.begins, len(keys))
        self.numbers = np.array([number for _, number in keys], np.int64)
        self.first = np.array([first[key] for key in keys], np.int64)
        self.last = np.array([last[key] for key in keys], np.int64)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.grams >> np.uint64(48)] = True

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the n-grams of the block in a text: which n-gram, and the word it begins at."""
        found, at = [], []
        for length in self.lengths:
            grams = runs(words, length)
            near = np.flatnonzero(self.maybe[grams >> np.uint64(48)])
            place = np.searchsorted(self.grams, grams[near])
            good = place < len(self.grams)
            good[good] = self.grams[place[good]] == grams[near[good]]
            found.append(place[good])
            at.append(near[good])
        return (np.concatenate(found), np.concatenate(at)) if found else (np.empty(0, np.int64), np.empty(0, np.int64))

    def spans(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, first and last word around every n-gram of an item that has as many others near it as the item needs."""
        found, at = self.hits(words)
        each = self.begins[found + 1] - self.begins[found]
        total = np.cumsum(each)
        rows = np.arange(total[-1] if len(total) else 0) - np.repeat(total - each - self.begins[found], each)
        at, number = np.repeat(at, each), self.numbers[rows]
        order = np.lexsort((at, number))
        rows, at, number = rows[order], at[order], number[order]
        begin = np.arange(len(rows))
        end = begin + self.need[number] - 1
        inside = np.flatnonzero(end < len(rows))
        end = end[inside]
        near = (number[end] == number[inside]) & (at[end] - at[inside] < self.reach[number[inside]])
        change = np.zeros(len(rows) + 1, np.int64)
        np.add.at(change, begin[inside[near]], 1)
        np.add.at(change, end[near] + 1, -1)
        live = np.cumsum(change[:-1]) > 0
        rows, at, number = rows[live], at[live], number[live]
        slack = self.slack[number]
        return number, at - self.last[rows] - slack, at - self.first[rows] + self.sizes[number] + slack

    def places(self, words: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """Passages to align with each item: spans that meet are one, and hold enough of its words close together."""
        overlap = int(self.reach.max(initial=0))
        parts = [[part[0], part[1] + at, part[2] + at] for at in range(0, max(1, len(words)), SLICE_WORDS) for part in [self.spans(words[at : at + SLICE_WORDS + overlap])]]
        number, first, last = (np.concatenate(column) for column in zip(*parts))
        out = defaultdict(list)
        if not len(number):
            return out
        order = np.lexsort((first, number))
        number, first, last = number[order], np.maximum(first[order], 0), np.minimum(last[order], len(words))
        # Ends of different items are kept apart by a whole text.
        apart = number * (len(words) + 1)
        furthest = np.maximum.accumulate(last + apart)
        new = np.append(True, first[1:] + apart[1:] > furthest[:-1])
        new[1:] |= number[1:] != number[:-1]
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(new)) - 1
        for item, a, b in zip(number[starts].tolist(), first[starts].tolist(), (furthest - apart)[ends].tolist()):
            bag, passage = self.bags[item], words[a:b]
            known = np.append(0, np.cumsum(bag[np.minimum(np.searchsorted(bag, passage), len(bag) - 1)] == passage))
            width = min(len(passage), int(self.reach[item]))
            if (known[width:] - known[: len(known) - width]).max() >= self.least_words[item]:
                out[item].append((a, b))
        return out

    def matches(self, words: np.ndarray, min_score: float) -> list[tuple[int, float, int, int]]:
        """Items in a text with the best score and the words it was found between."""
        out = []
        for number, spans in self.places(words).items():
            score, first, last = max((align(self.words[number], words[a:b]), -a, b) for a, b in spans)
            if score >= min_score:
                out.append((number, score, -first, last))
        return sorted(out)


def blocks(docs: DataFrame, items: DataFrame, *, item_col: str = "item_id", item_text: str = "text", min_score: float = MIN_SCORE, block_items: int = BLOCK_ITEMS) -> Iterator:
    """Blocks of items, ready for the tasks. Items of fewer than five words are too short to tell and are passed over."""
    rows = items.select(item_col, item_text).filter(F.col(item_text).isNotNull()).toLocalIterator()
    for block in batched(map(tuple, rows), block_items):
        made = Items(list(block), min_score)
        if made.lengths:
            yield docs.sparkSession.sparkContext.broadcast(made)


def find(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", min_score: float = MIN_SCORE, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``id, item, score, first_word, last_word``: the items found in each text.

    ``score`` is the best local alignment of the item with the text, 1 for an
    unchanged copy; those of ``min_score`` or more are returned, one row per row of
    texts and item. Repeated items are items of their own, and so are repeated rows. NULL and empty texts and items match nothing. Other
    columns are not looked at.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind, item_kind = named.schema["id"].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    schema = f"id {kind}, item {item_kind}, score double, first_word bigint, last_word bigint"
    found = docs.sparkSession.createDataFrame([], schema)
    for sent in blocks(docs, items, item_col=item_col, item_text=item_text, min_score=min_score, block_items=block_items):

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            in_use()
            for batch in batches:
                rows, out = [], []
                for i, text in enumerate(batch.column("text")):
                    for number, score, first, last in sent.value.matches(hashed_words(text.as_py()), min_score):
                        rows.append(i)
                        out.append((sent.value.ids[number], round(score, 6), first, last))
                columns = list(zip(*out)) if out else [()] * 4
                item_type = pa.array(sent.value.ids).type
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(rows, pa.int64())),
                        *(pa.array(c, k) for c, k in zip(columns, (item_type, pa.float64(), pa.int64(), pa.int64()))),
                    ],
                    ["id", "item", "score", "first_word", "last_word"],
                )

        found = found.unionByName(named.mapInArrow(search, schema))
    return found.withColumnsRenamed({"id": id_col, "item": item_col})


def without_items(docs: DataFrame, items: DataFrame, *, text_col: str = "text", min_score: float = MIN_SCORE, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs`` in which no item is found, as they are."""
    left = docs
    for sent in blocks(docs, items, min_score=min_score, block_items=block_items):

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            in_use()
            for batch in batches:
                keep = [not sent.value.matches(hashed_words(text.as_py()), min_score) for text in batch.column(text_col)]
                yield batch.filter(pa.array(keep, pa.bool_()))

        left = left.mapInArrow(clean, docs.schema)
    return left
