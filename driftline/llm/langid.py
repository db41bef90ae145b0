"""Language of texts: the family first, then pairwise linear classifiers within it."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.files import kept
from driftline.llm.held import only

UNDETERMINED = "und"
DIMENSIONS = 2048
# Bound of the sample the classifiers are fitted on.
TEXTS_PER_LANGUAGE = 800

# Families of common languages; any other language is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk", "bs"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "bn", "mr", "ne", "ur", "pa", "gu"),
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}

_letter_table: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Lower-case letter of each code point of the first plane, 0 for what is no letter."""
    global _letter_table
    if _letter_table is None:
        table = np.zeros(1 << 16, np.uint32)
        for code in range(1 << 16):
            char = chr(code)
            if char.isalpha():
                low = char.lower()
                table[code] = ord(low[0])
        _letter_table = table
    return _letter_table


def features(texts: list[str], dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """A row per text: root shares of its hashed runs of one to three letters, of length 1; and whether it has a letter.

    Anything but letters counts as one gap between words. A text without letters is all 0.
    """
    table = _letters()
    codes = np.frombuffer("".join(text + "\0" for text in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    # A text may hold the separator itself, so texts are told apart by their lengths.
    lengths = np.fromiter((len(text) + 1 for text in texts), np.int64, count=len(texts))
    of_text = np.repeat(np.arange(len(texts)), lengths)
    low = table[np.minimum(codes, 0xFFFF)]
    astral = codes > 0xFFFF
    if astral.any():
        low = low.copy()
        low[astral] = [code if chr(code).isalpha() else 0 for code in codes[astral]]
    word = low > 0
    has_letter = np.bincount(of_text[word], minlength=len(texts)) > 0
    keep = word.copy()
    keep[1:] |= word[:-1]  # one gap after each word
    low, of_text, word = low[keep], of_text[keep], word[keep]
    counts = np.zeros(len(texts) * dimensions)
    one = low * np.uint32(0x9E3779B1)
    mixed = one
    for length in (1, 2, 3):
        if length > 1:
            if len(low) < length:
                break
            mixed = (mixed[:-1] ^ (mixed[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + one[length - 1 :]
        ends = np.arange(len(mixed)) + length - 1
        same = of_text[: len(mixed)] == of_text[ends]
        if length == 1:
            same = same & word
        place = ((mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35) + np.uint32(length)) >> np.uint32(16)
        slots = of_text[: len(mixed)][same] * dimensions + place[same] % np.uint32(dimensions)
        counts += np.bincount(slots, minlength=len(counts))
    rows = np.sqrt(counts.reshape(len(texts), dimensions))
    norm = np.sqrt((rows**2).sum(axis=1, keepdims=True))
    return rows / np.maximum(norm, 1e-12), has_letter


@dataclass
class Duels:
    """Pairwise linear classifiers between ``names``; a positive margin is for the first of a pair."""

    names: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)
    offsets: list[float] = field(default_factory=list)

    def winners(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row the name with most duels won, ties by the summed margins, and how surely."""
        n = len(rows)
        if len(self.names) == 1:
            return np.zeros(n, int), np.ones(n)
        margins = rows @ np.array(self.weights).T + np.array(self.offsets)
        won, total = np.zeros((n, len(self.names))), np.zeros((n, len(self.names)))
        least = np.full((n, len(self.names)), np.inf)
        for k, (a, b) in enumerate(self.pairs):
            for side, margin in ((a, margins[:, k]), (b, -margins[:, k])):
                won[:, side] += margin > 0
                total[:, side] += margin
                least[:, side] = np.minimum(least[:, side], margin)
        best = np.lexsort((np.broadcast_to(-np.arange(len(self.names)), won.shape), total, won), axis=1)[:, -1]
        narrowest = least[np.arange(n), best]
        return best, 1 / (1 + np.exp(-2 * np.clip(narrowest, -30, 30)))


@dataclass
class Model:
    families: Duels
    within: dict[str, Duels]
    dimensions: int = DIMENSIONS

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if not texts or not self.families.names:
            return langs, scores
        rows, has_letter = features(texts, self.dimensions)
        family, sure = self.families.winners(rows)
        for number, name in enumerate(self.families.names):
            at = np.flatnonzero((family == number) & has_letter)
            if len(at):
                duels = self.within[name]
                best, surer = duels.winners(rows[at])
                for place, lang, score in zip(at, best, sure[at] * surer):
                    langs[place], scores[place] = duels.names[lang], float(score)
        return langs, scores


def _fit_duels(sample: DataFrame, label: str, names: list[str]) -> Duels:
    """One linear support vector machine per pair of names."""
    duels = Duels(names)
    for a, b in combinations(range(len(names)), 2):
        rows = sample.filter(F.col(label).isin(names[a], names[b])).select(
            "features", F.when(F.col(label) == names[a], 1.0).otherwise(0.0).alias("label")
        )
        fitted = LinearSVC(maxIter=25, regParam=1e-3, standardization=False, aggregationDepth=2).fit(rows)
        duels.pairs.append((a, b))
        duels.weights.append(fitted.coefficients.toArray())
        duels.offsets.append(float(fitted.intercept))
    return duels


def fit(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_language: int = TEXTS_PER_LANGUAGE, dimensions: int = DIMENSIONS) -> Model:
    """Classifiers learned from the rows with a language and a letter in their text.

    They are fitted on a sample of about ``per_language`` texts for each language,
    picked by a hash of the id, whole texts each. Ties go by name, so the same rows give the same
    model. Without any labelled row the model leaves all texts undetermined.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != ""))
    counts = rows.groupBy("lang").count().orderBy("lang").collect()
    if not counts:
        return Model(Duels([]), {}, dimensions)
    share = F.create_map(*[F.lit(x) for row in counts for x in (row["lang"], min(1.0, per_language / row["count"]))])
    picked = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                found, has_letter = features(part.column("text").to_pylist(), dimensions)
                lists = pa.array(list(found[has_letter].astype(np.float32)), pa.list_(pa.float32()))
                langs = part.column("lang").filter(pa.array(has_letter))
                yield pa.RecordBatch.from_arrays([langs, lists], ["lang", "features"])

    family = F.coalesce(F.create_map(*[F.lit(x) for pair in FAMILY_OF.items() for x in pair])[F.col("lang")], F.concat(F.lit("="), "lang"))
    turned = rows.filter(picked).select("lang", "text").mapInArrow(turn, "lang string, features array<float>")
    sample = kept(turned, "language-sample")
    learned = sorted(row["lang"] for row in sample.select("lang").distinct().collect())
    if not learned:
        return Model(Duels([]), {}, dimensions)
    sample = sample.withColumn("family", family).withColumn("features", array_to_vector(F.col("features").cast("array<double>")))
    members = defaultdict(list)
    for lang in learned:
        members[FAMILY_OF.get(lang, f"={lang}")].append(lang)
    return Model(
        _fit_duels(sample, "family", sorted(members)),
        {name: _fit_duels(sample, "lang", langs) for name, langs in members.items()},
        dimensions,
    )


def predict(docs: DataFrame, model: Model, *, text_col: str = "text", keep: list[str], lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """The columns ``keep`` with the predicted language and its score from 0 to 1.

    Whole texts count, and nothing but the text. A NULL text and one without a
    letter is ``und`` with score 0. Rows are judged each for itself.
    """
    named = docs.select(*[F.col(name).alias(f"c{i}") for i, name in enumerate(keep)], F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("languages", lambda: None)
        for batch in batches:
            begin = 0
            texts = batch.column("text").to_pylist()
            while begin < len(texts):
                # As many texts at a time as have half a million characters, one at least.
                end, held = begin, 0
                while end < len(texts) and (end == begin or (held + len(texts[end]) <= 500_000 and end - begin < 500)):
                    held += len(texts[end])
                    end += 1
                langs, scores = model.predict(texts[begin:end])
                carried = batch.slice(begin, end - begin).columns[:-1]
                names = [f"c{i}" for i in range(len(carried))] + ["lang", "score"]
                yield pa.RecordBatch.from_arrays([*carried, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names)
                begin = end

    kinds = [f"c{i} {named.schema[i].dataType.simpleString()}" for i in range(len(keep))]
    labelled = named.mapInArrow(label, ", ".join([*kinds, "lang string", "score double"]))
    return labelled.toDF(*keep, lang_name, score_name)


def with_letters(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The rows whose text has a letter, as ``predict`` tells them; they have a language, learned or not."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col)
            yield batch.filter(pa.array([any(map(str.isalpha, text.as_py() or "")) for text in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from learning: the CRC-32 of its id as text leaves 2 by 4. NULL ids are not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, *, id_col: str = "doc_id") -> Model:
    """The model of the documents that are not held out and have an id."""
    return fit(docs.filter(F.col(id_col).isNotNull() & ~held_out(id_col)), id_col=id_col)
