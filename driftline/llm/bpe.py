"""BPE encoding and decoding by tree concatenation."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.words import WordEnds, load_tokenizer, word_ends

LEAF_CHARS = 16_384
FIRST_WINDOW = 32
EDGE_TOKENS = 80
# Texts a task holds in Python at a time.
SLICE = 250


class Piece:
    """Ids of the characters from ``begin`` to ``end`` of a text, with the spans of its outer tokens.

    ``head`` and ``tail`` hold (starts, ends) of the first and last tokens; both
    hold all of them if the piece has no more than ``EDGE_TOKENS``.
    """

    def __init__(self, begin: int, end: int, ids, head, tail) -> None:
        self.begin, self.end, self.ids, self.head, self.tail = begin, end, ids, head, tail


def _edges(starts, ends):
    return (starts[:EDGE_TOKENS], ends[:EDGE_TOKENS]), (starts[-EDGE_TOKENS:], ends[-EDGE_TOKENS:])


def _whole(encoder: WordEnds, text: str, begin: int, end: int) -> Piece:
    ids, starts, ends = encoder.spans(text[begin:end])
    return Piece(begin, end, ids, *_edges(starts + begin, ends + begin))


def _edge_spans(encoder: WordEnds, text: str, begin: int, from_end: bool):
    """Spans of the first or last ``EDGE_TOKENS`` tokens, from as many whole words at that end as hold them."""
    width = EDGE_TOKENS
    while True:
        if from_end:
            at = 0 if width >= len(text) else text.rfind(" ", 0, len(text) - width) + 1
            _, starts, ends = encoder.spans(text[at:])
            starts, ends = starts + begin + at, ends + begin + at
        else:
            upto = len(text) if width >= len(text) else text.find(" ", width) % (len(text) + 1)
            at, (_, starts, ends) = len(text) - upto, encoder.spans(text[:upto])
            starts, ends = starts + begin, ends + begin
        if len(starts) >= EDGE_TOKENS or not at:
            return (starts[-EDGE_TOKENS:], ends[-EDGE_TOKENS:]) if from_end else (starts[:EDGE_TOKENS], ends[:EDGE_TOKENS])
        width *= 2


def encode_leaf(encoder: WordEnds, text: str, begin: int, end: int) -> Piece:
    part = text[begin:end]
    (ids,) = encoder.encode([part])
    return Piece(begin, end, ids, _edge_spans(encoder, part, begin, False), _edge_spans(encoder, part, begin, True))


def _starts_fresh(char: str) -> bool:
    """Whether normalisation leaves ``char`` apart from what stands before it."""
    return char < "̀" or not (unicodedata.category(char)[0] == "M" or "ᅠ" <= char <= "ᇿ")


def _same(ids, starts, ends, other_ids, other_starts, other_ends) -> bool:
    return (
        len(ids) == len(other_ids)
        and np.array_equal(ids, other_ids)
        and np.array_equal(starts, other_starts)
        and np.array_equal(ends, other_ends)
    )


def concatenate(encoder: WordEnds, text: str, left: Piece, right: Piece) -> Piece:
    """One piece from two neighbours.

    A window of tokens around the join is encoded again from the text. If its
    first half-window equals the tokens the left side has there, and tokens ahead
    of its end equal those the right side has there, ids and spans alike, the two
    sides and the window are parts of one encoding: BPE is settled pair by pair,
    so a row of tokens in which all neighbours stand is the only encoding. Else
    the window doubles, in the end to both pieces as a whole. The half-window is
    longer than any special token, and a window begins at no combining mark.
    """
    n_left, n_right = len(left.ids), len(right.ids)
    width = FIRST_WINDOW
    while True:
        from_left, to_right = min(width, n_left), min(width, n_right)
        over = min(to_right + width // 2, n_right)  # read past the last compared token
        known_left = from_left <= len(left.tail[0])
        known_right = over <= len(right.head[0])
        whole_left, whole_right = from_left == n_left, over == n_right
        if not (known_left or whole_left) or not (known_right or whole_right) or (whole_left and whole_right):
            break
        begin = left.begin if whole_left else int(left.tail[0][len(left.tail[0]) - from_left])
        end = right.end if whole_right else int(right.head[1][over - 1])
        safe = (whole_left or _starts_fresh(text[begin])) and (end == right.end or _starts_fresh(text[end]))
        if safe:
            ids, starts, ends = encoder.spans(text[begin:end])
            starts, ends = starts + begin, ends + begin
            half = width // 2
            agree_left = whole_left or (
                _same(
                    ids[:half],
                    starts[:half],
                    ends[:half],
                    left.ids[n_left - from_left :][:half],
                    left.tail[0][len(left.tail[0]) - from_left :][:half],
                    left.tail[1][len(left.tail[1]) - from_left :][:half],
                )
            )
            if whole_right:
                cut, agree_right = len(ids), True
            else:
                # The window's tokens that end with the last compared token of the right side.
                cut = int(np.searchsorted(ends, right.head[1][to_right - 1], side="right"))
                agree_right = cut >= half and _same(
                    ids[cut - half : cut],
                    starts[cut - half : cut],
                    ends[cut - half : cut],
                    right.ids[to_right - half : to_right],
                    right.head[0][to_right - half : to_right],
                    right.head[1][to_right - half : to_right],
                )
            if agree_left and agree_right:
                taken = n_right if whole_right else to_right
                joined = np.concatenate([left.ids[: n_left - from_left], ids[:cut], right.ids[taken:]])
                head, tail = _joined_edges(left, right, from_left, taken, starts[:cut], ends[:cut], len(joined))
                if head is not None:
                    return Piece(left.begin, right.end, joined, head, tail)
                break
        width *= 2
    return _whole(encoder, text, left.begin, right.end)


def _joined_edges(left: Piece, right: Piece, from_left: int, taken: int, starts, ends, size: int):
    """Spans of the outer tokens of two pieces with a window between, or None if they are not all known."""
    want = min(EDGE_TOKENS, size)
    n_left, n_right = len(left.ids), len(right.ids)
    kept_left, kept_right = n_left - from_left, n_right - taken
    # From the left: what the left piece keeps, the window, what the right piece keeps.
    if kept_left <= len(left.head[0]):
        begun = [left.head[0][:kept_left], starts]
        done = [left.head[1][:kept_left], ends]
        if kept_left + len(starts) < want:
            if taken + want - kept_left - len(starts) > len(right.head[0]):
                return None, None
            begun.append(right.head[0][taken:])
            done.append(right.head[1][taken:])
        head = np.concatenate(begun)[:want], np.concatenate(done)[:want]
    else:
        head = left.head[0][:want], left.head[1][:want]
    if len(head[0]) < want:
        return None, None
    if kept_right <= len(right.tail[0]):
        at = len(right.tail[0]) - kept_right
        begun, done = [starts, right.tail[0][at:]], [ends, right.tail[1][at:]]
        if kept_right + len(starts) < want:
            upto = len(left.tail[0]) - from_left
            if upto < want - kept_right - len(starts):
                return None, None
            begun.insert(0, left.tail[0][:upto])
            done.insert(0, left.tail[1][:upto])
        tail = np.concatenate(begun)[-want:], np.concatenate(done)[-want:]
    else:
        tail = right.tail[0][-want:], right.tail[1][-want:]
    return (head, tail) if len(tail[0]) >= want else (None, None)


def concatenate_tree(encoder: WordEnds, text: str, pieces: list[Piece]) -> np.ndarray:
    """Ids of the whole text from its leaves in order, joined two by two."""
    while len(pieces) > 1:
        paired = [
            concatenate(encoder, text, pieces[i], pieces[i + 1]) if i + 1 < len(pieces) else pieces[i]
            for i in range(0, len(pieces), 2)
        ]
        pieces = paired
    return pieces[0].ids


def leaf_bounds(length: int, leaf_chars: int) -> list[int]:
    """Where to cut: halves of halves until none is longer than ``leaf_chars``."""
    parts = 1
    while length > parts * leaf_chars:
        parts *= 2
    return [length * i // parts for i in range(parts + 1)]


def _short(ids: np.ndarray) -> bytes:
    """Ids as numbers of two bytes if they fit, else four, and the size of a number at the end."""
    size = 2 if ids.max(initial=0) < 1 << 16 else 4
    return ids.astype(f"<u{size}").tobytes() + bytes([size])


def _id_lists(arrays) -> pa.Array:
    lengths = np.fromiter(map(len, arrays), dtype=np.int64, count=len(arrays))
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    values = np.concatenate(arrays).astype(np.int32) if len(arrays) else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def encode(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``id, ids``: the ids of every whole text, as the tokenizer gives them for it in one go.

    A text of up to ``leaf_chars`` is one leaf. A longer one is cut into halves
    until its leaves are no longer than that; the leaves are rows of their own and
    are encoded in parallel, then joined two by two (see ``concatenate``), which
    meets one text at a time. NULL and empty texts have no ids. Rows with the same
    id, NULL ids included, are encoded each for itself and all returned. Other
    columns are not looked at. The order of the rows is not kept.
    """
    named = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = named.schema["id"].dataType.simpleString()

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ends(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                arrays = encoder.encode(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("id"), _id_lists(arrays)], ["id", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                bounds = leaf_bounds(len(row["text"]), leaf_chars)
                n = len(bounds) - 1
                texts = [row["text"][bounds[k] : bounds[k + 1]] for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["id"]] * n, batch.schema.field("id").type),
                        pa.array([row["row"]] * n, pa.int64()),
                        pa.array(bounds[:-1], pa.int64()),
                        pa.array(texts, pa.string()),
                    ],
                    ["id", "row", "begin", "text"],
                )

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ends(tokenizer_path)
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1)
                text, begin = part.column("text")[0].as_py(), part.column("begin")[0].as_py()
                piece = encode_leaf(encoder, text, 0, len(text))
                spans = [*piece.head, *piece.tail]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([_short(piece.ids)]), *(pa.array([(s + begin).tolist()], pa.list_(pa.int64())) for s in spans)],
                    ["id", "row", "begin", "text", "ids", "head_starts", "head_ends", "tail_starts", "tail_ends"],
                )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ends(tokenizer_path)
        rows: list[dict] = []

        def done() -> pa.RecordBatch:
            text = "".join(row["text"] for row in rows)
            pieces = []
            for row in rows:
                spans = [np.asarray(row[name], np.int64) for name in ("head_starts", "head_ends", "tail_starts", "tail_ends")]
                ids = np.frombuffer(row["ids"], f"<u{row['ids'][-1]}", count=len(row["ids"]) // row["ids"][-1])
                pieces.append(Piece(row["begin"], row["begin"] + len(row["text"]), ids, tuple(spans[:2]), tuple(spans[2:])))
            whole = concatenate_tree(encoder, text, pieces)
            return pa.RecordBatch.from_arrays([pa.array([rows[0]["id"]], id_type), _id_lists([whole])], ["id", "ids"])

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("id").type
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                if rows and rows[0]["row"] != row["row"]:
                    yield done()
                    rows = []
                rows.append(row)
        if rows:
            yield done()

    ids_schema = f"id {kind}, ids array<int>"
    is_long = F.length("text") > leaf_chars
    encoded = named.filter(~is_long).mapInArrow(short, ids_schema)
    # A number per row tells rows with the same id and text apart; it stays with the row from here on.
    numbered = named.filter(is_long).withColumn("row", F.monotonically_increasing_id())
    pieces = numbered.mapInArrow(cut, f"id {kind}, row bigint, begin bigint, text string").repartition("row", "begin")
    spans = "head_starts array<bigint>, head_ends array<bigint>, tail_starts array<bigint>, tail_ends array<bigint>"
    coded = pieces.mapInArrow(leaves, f"id {kind}, row bigint, begin bigint, text string, ids binary, {spans}")
    joined = coded.repartition("row").sortWithinPartitions("row", "begin").mapInArrow(join, ids_schema)
    return encoded.unionByName(joined).withColumnRenamed("id", id_col)


_tables: dict[str, tuple] = {}


def _pieces_of(path: str):
    """Written form of each id, None at the end, and whether a decoder other than joining with spaces is set."""
    if path not in _tables:
        tokenizer = load_tokenizer(path)
        size = max(tokenizer.get_vocab(with_added_tokens=True).values(), default=-1) + 1
        written = np.array([*(tokenizer.id_to_token(i) for i in range(size)), None], dtype=object)
        plain = tokenizer.decoder is None
        _tables[path] = (None if plain else tokenizer, written, plain)
    return _tables[path]


def decode(encoded: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id, ids, text``: the text the tokenizer gives for the ids, special tokens included.

    Without a decoder in its file the written forms are joined by spaces; ids it
    does not have are left out. No or NULL ids give the empty text.
    """
    named = encoded.select(F.col(id_col).alias("id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    kind = named.schema["id"].dataType.simpleString()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, written, plain = _pieces_of(tokenizer_path)
        size = len(written) - 1
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                lists = part.column("ids")
                if plain:
                    ids = lists.flatten().to_numpy(zero_copy_only=False)
                    bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
                    tokens = written[np.where((ids >= 0) & (ids < size), ids, size)]
                    out = [" ".join([t for t in tokens[a:b].tolist() if t is not None]) for a, b in zip(bounds, bounds[1:])]
                else:
                    out = tokenizer.decode_batch(lists.to_pylist(), skip_special_tokens=False)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("ids"), pa.array(out, pa.string())], ["id", "ids", "text"])

    return named.mapInArrow(texts, f"id {kind}, ids array<int>, text string").withColumnRenamed("id", id_col)


def digest(decoded: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` of ids and the text they give."""
    return decoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
