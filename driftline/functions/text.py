"""Tokens, n-grams and counts over a text column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a run of two or more word characters in any script,
# a word a run of one or more, a sentence a stretch between . ! ? with a word.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
WORD_PATTERN = r"[\p{L}\p{N}_]+"
SENTENCE_ENDS = r"[.!?]+"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def without_words(words: Column, unwanted) -> Column:
    """Drop unwanted words but keep order and repeats, which n-grams need.

    The literal list becomes a hash set in the plan, so the cost per token does
    not depend on its length.
    """
    unwanted = list(unwanted)
    return F.filter(words, lambda word: ~word.isin(unwanted)) if unwanted else words


def ngrams(words: Column, lowest: int = 1, highest: int = 3) -> Column:
    """All runs of ``lowest`` to ``highest`` neighbouring words, joined by a space.

    ``words`` should be a plain column: it is referred to more than once. A run
    that would pass the end of the list is NULL and dropped.
    """

    def starting_at(word, place):
        run, runs = word, []
        for size in range(1, highest + 1):
            if size > 1:
                run = F.concat(run, F.lit(" "), F.get(words, place + (size - 1)))
            if size >= lowest:
                runs.append(run)
        return F.array(*runs)

    if highest == 1:
        return words
    return F.array_compact(F.flatten(F.transform(words, starting_at)))


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0)))


def sentence_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, SENTENCE_ENDS), lambda part: part.rlike(WORD_PATTERN)))


def letter_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
