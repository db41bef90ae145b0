"""Hashed words and word shingles of whole texts, for work inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from driftline.llm import held

MAX_WORDS = 150_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


class WordHashes(dict):
    """64-bit hash per word; starts anew when it holds too many words."""

    def __missing__(self, word: bytes | str) -> int:
        if len(self) > MAX_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = WordHashes()


def in_use() -> None:
    """Said by tasks that hash words: hashes are kept until tasks of another kind begin."""
    held.only("words", _hashes.clear)


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but space and the characters 9 to 13, as UTF-8."""
    return (text or "").encode("utf-8").split()


def word_hashes(words: list[bytes] | list[str]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, count=len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers over all their places."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every ``length`` consecutive words; order counts. Fewer words, no runs."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, np.uint64(length), np.uint64)
    for k in range(length):
        total = mix(total * _ODD[k % 5] + hashes[k : k + n])
    return total


def shingle_set(text: str | None, length: int) -> np.ndarray:
    """Distinct hashed shingles, in ascending order. Fewer words than a shingle count as one, no words as none.

    Letters A to Z count as lower case.
    """
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    return np.unique(runs(hashes, min(length, len(words))))
