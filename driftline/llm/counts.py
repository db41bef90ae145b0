"""Token counts of the sections of texts, from one encoding of the whole text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.words import ByteWords, byte_words

RULES = ("start", "end", "overlap")


def token_spans(words: ByteWords, sizes, text: str):
    """First and next character of each id; ids that share a character both span it."""
    ids = words.encode(text)
    begun, inside = sizes
    ends = np.cumsum(begun[ids]) if len(ids) else np.empty(0, np.int64)
    starts = ends - begun[ids] - inside[ids]
    return ids, starts, ends


def line_spans(text: str) -> list[tuple[int, int]]:
    """Lines with the break that ends them; together they are the text. No text, no lines."""
    return [found.span() for found in re.finditer(r"[^\n]*\n|[^\n]+", text)]


def section_of(starts, ends, first, last, rule: str):
    """The place of the section each token span goes to, -1 for none.

    Sections [first, last) are in ascending order and apart from each other; empty
    ones get nothing. ``start``: the section with the token's first character.
    ``end``: with its last. ``overlap``: with most of its characters, the earlier
    one of equals.
    """
    if not len(first):
        return np.full(len(starts), -1)

    def holding(at):
        place = np.searchsorted(first, at, side="right") - 1
        return np.where((place >= 0) & (at < last[np.maximum(place, 0)]), place, -1)

    if rule == "start":
        return holding(starts)
    if rule == "end":
        return holding(np.maximum(ends - 1, starts))
    # Sections from the first that ends behind the token's start to the last that begins ahead of its end.
    low, high = np.searchsorted(last, starts, side="right"), np.searchsorted(first, np.maximum(ends, starts + 1), side="left") - 1
    chosen = np.where(low <= high, low, -1)
    for token in np.flatnonzero(high > low):
        parts = np.arange(low[token], high[token] + 1)
        covered = np.minimum(last[parts], ends[token]) - np.maximum(first[parts], starts[token])
        chosen[token] = parts[np.argmax(covered)]
    return chosen


def attribute(docs: DataFrame, tokenizer_path: str, ranks_path: str, *, sections_col: str | None = None, rule: str = "overlap", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, section_no, start, end, n_tokens, n_crossing``: tokens of each section of each text.

    A text is encoded once as a whole and the character spans of its tokens are
    joined to the sections: its lines with their breaks, or the ascending, disjoint
    ``array<struct<start, end>>`` of ``sections_col``. A token that crosses a
    boundary goes to one section by ``rule`` (see ``section_of``); ``n_crossing``
    counts those among ``n_tokens``. Tokens outside all sections are counted in a
    row with section -1, if there are any, so the counts of a text add up to its
    tokens. NULL and empty texts have no row unless sections are given. Rows with
    the same id stay apart.
    """
    if rule not in RULES:
        raise ValueError(rule)
    given = F.col(sections_col) if sections_col else F.lit(None)
    cells = given.cast("array<struct<start:bigint,end:bigint>>")
    named = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *([cells.alias("sections")] if sections_col else []))
    kind = named.schema["id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = byte_words(tokenizer_path, ranks_path)
        sizes = words.chars_per_id()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                sources, out = [], [[], [], [], [], []]
                texts = batch.column("text").to_pylist()
                sections = batch.column("sections").to_pylist() if sections_col else None
                for i, text in enumerate(texts):
                    spans = line_spans(text) if sections is None else [(s["start"], s["end"]) for s in sections[i] or []]
                    first = np.asarray([s[0] for s in spans], np.int64)
                    last = np.asarray([s[1] for s in spans], np.int64)
                    _, starts, ends = token_spans(words, sizes, text)
                    chosen = section_of(starts, ends, first, last, rule)
                    n_tokens = np.bincount(chosen + 1, minlength=len(spans) + 1)
                    inside = np.where(chosen >= 0, (starts >= first[chosen]) & (ends <= last[chosen]), True) if len(spans) else np.ones(len(starts), bool)
                    crossing = np.bincount(chosen + 1, weights=~inside, minlength=len(spans) + 1)
                    from_row = 0 if n_tokens[0] else 1
                    n = len(spans) + 1 - from_row
                    sources += [i] * n
                    out[0].append(np.arange(-1 + from_row, len(spans)))
                    out[1].append(np.concatenate([[0], first])[from_row:])
                    out[2].append(np.concatenate([[len(text)], last])[from_row:])
                    out[3].append(n_tokens[from_row:])
                    out[4].append(crossing[from_row:].astype(np.int64))
                ids = batch.column("id").take(pa.array(sources, pa.int64()))
                columns = [pa.array(np.concatenate(part).astype(np.int64)) for part in out]
                yield pa.RecordBatch.from_arrays([ids, *columns], ["id", "section_no", "start", "end", "n_tokens", "n_crossing"])

    schema = f"id {kind}, section_no bigint, start bigint, end bigint, n_tokens bigint, n_crossing bigint"
    return named.mapInArrow(count, schema).withColumnRenamed("id", id_col)
