"""The whole pipeline against a plain version of its stages, row by row."""

import hashlib
import random
import re

import public_tokenizers

import corpus_pipeline
from driftline.llm import decontaminate, pii
from driftline.llm.words import load_tokenizer

from .test_copies import WORD, least
from .test_native import BASE, luhn

KIND_ORDER = {kind: number for number, kind in enumerate(pii.KINDS)}


def one_of_each(rows):
    """Of rows that share 80 % of their five-word shingles, over any number of steps, the one with the least id."""
    sets = []
    for _, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    links = []
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                links.append((b, a))
    groups = {}
    for at, top in least(links, range(len(rows))).items():
        groups.setdefault(top, []).append(rows[at])
    return [min(group, key=lambda row: (row[0] is None, row[0] or 0)) for group in groups.values()]


def without_items(rows, items):
    hashed = [words for words in (decontaminate.hashed_words(item) for item in items) if len(words) >= 5]
    left = []
    for doc, text in rows:
        words = decontaminate.hashed_words(text)
        if not any(decontaminate.align(item, words) >= 0.6 for item in hashed):
            left.append((doc, text))
    return left


def base_matches(text):
    for kind, pattern in BASE.items():
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            if (
                kind == "email"
                or (kind == "ip" and all(int(part) <= 255 for part in match[0].split(".")))
                or (kind == "card" and 14 <= len(digits) <= 19 and luhn(digits))
                or (kind == "phone" and 10 <= len(digits) <= 15)
            ):
                yield match.start(), KIND_ORDER[kind], match.end(), kind


def masked(text, added):
    out, at = "", 0
    for start, _, end, kind in sorted([*base_matches(text), *added]):
        if start >= at:
            out += text[at:start] + f"[{kind.upper()}]"
        at = max(at, end)
    return out + text[at:]


def test_pipeline_is_its_plain_stages(spark, sf, tmp_path):
    rng = random.Random(2)
    given = spark.read.parquet(f"{sf}/documents.parquet")
    items = [row.text for row in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    long = " ".join(f"k{rng.randrange(9999)}" for _ in range(150))
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    odd = [(9001, None), (9002, ""), (9003, "12 34"), (9004, long), (9005, long + " end"), (9006, f"so {items[0]} then"), (None, long + " last")]
    odd += [(9007, f"mail me: a@b.cc, password {key}, DE89370400440532013000 Thank you"), (9008, "call +49 151 2345678 or 4111 1111 1111 1111"), (None, "no id here")]
    # Two texts under one id, one of them a copy; a row given twice.
    odd += [(9009, long.replace("k1", "k2", 1) + " more"), (9009, "another text of the same id"), (9010, "given twice"), (9010, "given twice")]
    docs = given.unionByName(spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in odd], given.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")

    rows = [(row.doc_id, row.text) for row in docs.collect()]
    rows = [(doc, text) for doc, text in rows if any(map(str.isalpha, text or ""))]
    rows = without_items(one_of_each(rows), items)
    # Numbers and keys beyond the base kinds have tests of their own.
    found = pii.find(spark.createDataFrame([(i, text) for i, (_, text) in enumerate(rows)], "doc_id long, text string")).collect()
    added = {row.doc_id: [(s.start, s.kind_no, s.end, s.kind) for s in row.spans if s.kind not in BASE] for row in found}
    assert {kind for spans in added.values() for *_, kind in spans} == {"iban", "secret"}
    tokenizer = load_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for i, (doc, text) in enumerate(rows):
        ids = tokenizer.encode(masked(text, added[i]), add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        expected.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
