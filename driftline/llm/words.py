"""Exact ids of whole texts, one space-separated word at a time, with a bounded memory of words.

Both tokenizers cut a text in front of every space that follows something else
than white space, so words can be encoded apart and their ids joined. Frequent
words are then encoded once per worker instead of once per use.
"""

from __future__ import annotations

import base64
import json
import os
import re

import numpy as np

from driftline.llm import held

MAX_WORDS = 200_000
MAX_WORD_CHARS = 64
ID_BYTES = 4


def load_tokenizer(path: str):
    """The tokenizer of a file, on one thread and without truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _packed(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


# Words of letters, digits and signs that normalisation only lowers, and how they are cut.
_LOW = re.compile("[!-~À-ÖØ-öø-įı-ſ]{1,200}")
_CUT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+")
_CUTTER = {
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    "normalizers": ["NFC", "Replace", "Lowercase"],
}
_MARK, _BREAK = "\0", "\1"


def _ranks(described: dict):
    """The merges of a tokenizer with word ends as ranks of byte strings, a zero byte for the end; None if it is of another kind.

    The first 256 ids are single bytes and the next 256 the same with a word end,
    so with the zero byte as a token of its own the end is always merged first.
    """
    steps = [part["type"] for part in (described["normalizer"] or {}).get("normalizers", [])]
    cut = (described["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
    model = described["model"]
    if steps != _CUTTER["normalizers"] or cut != _CUTTER["pattern"] or model["end_of_word_suffix"] != "</w>" or model["ignore_merges"]:
        return None
    from tokenizers.pre_tokenizers import ByteLevel

    # The alphabet stands for the bytes in its own order: printable ones first.
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    bytes_of = {chr(byte): byte for byte in printable} | {chr(256 + i): byte for i, byte in enumerate(others)}
    assert set(bytes_of) == set(ByteLevel.alphabet())
    ranks = {}
    for token, number in model["vocab"].items():
        raw = bytes(bytes_of[char] for char in token.removesuffix("</w>"))
        ranks[raw + b"\0" if token.endswith("</w>") else raw] = number
    merged = [number for raw, number in ranks.items() if len(raw) > 1]
    in_order = [model["vocab"]["".join(pair)] for pair in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
    return ranks if in_order == sorted(in_order) and len(merged) == len(in_order) + 256 and min(merged) >= 256 else None


class WordEnds:
    """Texts of a tokenizer that drops white space: every word stands alone.

    Plain words are merged by ranks, which gives the same ids faster; all others
    go through the tokenizer itself.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = load_tokenizer(path)
        self.known: dict[str, bytes] = {"": b""}
        ranks = _ranks(json.loads(self.tokenizer.to_str()))
        self.merge = None
        if ranks:
            import tiktoken

            self.merge = tiktoken.Encoding("ranks", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            self.break_id = ranks[b"\1\0"]

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of all of ``words``; what is too long to be met again is not kept."""
        if len(self.known) > MAX_WORDS:
            self.known = {"": b""}
        new, plain, rare = [], [], {}
        for word in words:
            if word not in self.known:
                (plain if self.merge and _LOW.fullmatch(word) and "<|" not in word else new).append(word)
        for at in range(0, len(plain), 4096):
            # Many words at a time, an otherwise unused piece between them.
            part = plain[at : at + 4096]
            pieces = [piece for word in part for piece in (*_CUT.findall(word.lower()), _BREAK)]
            ids = np.array(self.merge(_MARK.join(pieces) + _MARK), dtype="<u4")
            ends = np.flatnonzero(ids == self.break_id)
            packed, begin = ids.tobytes(), 0
            for word, end in zip(part, (ends * 4).tolist(), strict=True):
                (self.known if len(word) <= MAX_WORD_CHARS else rare)[word] = packed[begin:end]
                begin = end + 4
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            for word, coded in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False)):
                (self.known if len(word) <= MAX_WORD_CHARS else rare)[word] = _packed(coded.ids)
        return rare

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [text.split(" ") for text in texts]
        rare = self.learn(set().union(*cut)) if cut else {}
        known = self.known.__getitem__
        either = (lambda word: rare[word] if word in rare else known(word)) if rare else known
        return [np.frombuffer(b"".join(map(either, words)), dtype="<u4") for words in cut]

    def spans(self, text: str):
        """Ids with the first and the next character of each."""
        coded = self.tokenizer.encode(text, add_special_tokens=False)
        at = np.asarray(coded.offsets, dtype=np.int64).reshape(-1, 2)
        return np.asarray(coded.ids, dtype="<u4"), at[:, 0], at[:, 1]


# Letters, digits and signs whose classes no version of Unicode has changed.
_PLAIN = re.compile("[\t\n\r!-~\xa1-\xac\xae-ɏ]+")
_PLAIN_WORD = re.compile("[!-~\xa1-\xac\xae-ɏ]+")


class ByteWords(dict):
    """Texts of the byte-level tokenizer: a word brings the space before it along.

    Plain words go through the rank file of the same vocabulary, which gives the
    same ids faster; all others, and the special token, through the tokenizer file.
    """

    def __init__(self, path: str, ranks_path: str) -> None:
        import tiktoken

        super().__init__()
        self.tokenizer = load_tokenizer(path)
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        # Fixed value: the pattern of the vocabulary.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        (self.line,) = self.ranks.encode_ordinary("\n")

    def _ids(self, chunk: str) -> bytes:
        if len(chunk) <= 400 and "<|" not in chunk and _PLAIN.fullmatch(chunk.removeprefix(" ")):
            return _packed(self.ranks.encode_ordinary(chunk))
        return _packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def __missing__(self, word: str) -> bytes:
        if not word or word[-1].isspace():
            raise KeyError(word)  # white space that runs on into the next word
        ids = self._ids(" " + word)
        if len(word) <= MAX_WORD_CHARS:
            if len(self) > MAX_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        first, *words = text.split(" ")
        try:
            if first and first[-1].isspace():
                raise KeyError(first)
            packed = (self._ids(first) if first else b"") + b"".join(map(self.__getitem__, words))
        except KeyError:
            # Cut only where a space follows something else than white space.
            packed = b"".join(map(self._ids, re.split(r"(?<=[^\s\x1c-\x1f\x85])(?= )", text)))
        return np.frombuffer(packed, dtype="<u4")

    def learn(self, words: set[str]) -> None:
        """Remember the ids of many plain words by one call; all others are encoded when they are met.

        Between two words stands a line end, which is a token of its own in front
        of a space and part of no plain word.
        """
        if len(self) + len(words - self.keys()) > MAX_WORDS:
            self.clear()
        new = [word for word in words if word not in self and len(word) <= MAX_WORD_CHARS and "<|" not in word and _PLAIN_WORD.fullmatch(word)]
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            ids = np.array(self.ranks.encode_ordinary(" " + "\n ".join(part) + "\n"), dtype="<u4")
            ends = np.flatnonzero(ids == self.line)
            packed, begin = ids.tobytes(), 0
            for word, end in zip(part, (ends * 4).tolist(), strict=True):
                self[word] = packed[begin:end]
                begin = end + 4

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; new words of all of them are looked up together."""
        self.learn(set().union(*(text.split(" ") for text in texts)))
        return [self.encode(text) for text in texts]

    def chars_per_id(self):
        """Characters that begin in each id's bytes, and whether the bytes begin inside a character."""
        size = self.tokenizer.get_vocab_size()
        begun, inside = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=bool)
        for number in range(size):
            token = self.ranks.decode_single_token_bytes(number) if number < self.ranks.n_vocab else b""
            if number == self.tokenizer.token_to_id("<|endoftext|>"):
                token = b"<|endoftext|>"
            begun[number] = sum(byte & 0xC0 != 0x80 for byte in token)
            inside[number] = bool(token) and token[0] & 0xC0 == 0x80
        return begun, inside


_loaded: dict[tuple, object] = {}


def word_ends(path: str) -> WordEnds:
    """One per worker process and file."""
    in_use()
    return _loaded.get((path,)) or _keep((path,), WordEnds(path))


def byte_words(path: str, ranks_path: str) -> ByteWords:
    in_use()
    key = (path, ranks_path)
    return _loaded[key] if key in _loaded else _keep(key, ByteWords(path, ranks_path))


def _keep(key: tuple, made):
    _loaded[key] = made
    return made


def in_use() -> None:
    """Said by tasks that encode: encoders are kept until tasks of another kind begin."""
    held.only("encoders", _loaded.clear)
