"""Personal data and quality rules against plain Python."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from driftline.llm import pii, quality, queries
from .conftest import texts

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text):
    found = []
    for number, (kind, pattern) in enumerate(BASE.items()):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(part) <= 255 for part in match[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((match.start(), number, match.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def test_base_spans(spark):
    rng = random.Random(5)
    parts = ["a", "b.c", "@", "x@y.zz", "%", "-", "+", " ", "1.2.3.4", "255.", "256", "4111 1111 1111 1111", "4111111111111111", "é", "😀"]
    parts += ["+49 (0) 151-2345678", "5", ".", " 1-2 ", "\n", "DE89370400440532013000", "visa ", "00255.0.0.1", "5500-0000-0000-0004"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.choice([1, 3, 10, 40, 120])))) for i in range(700)]
    rows += [(9000, None), (9001, ""), (9002, "9" * 30000), (9003, "a" * 60000), (9004, "1 " * 20000), (9005, "+1" + "(" * 30000)]
    rows += [(9006, "a@b.cc " * 300), (5, rows[5][1]), (None, rows[6][1])]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.base_sha256) for r in pii.digest(pii.find(texts(spark, rows))).collect())
    sums = [(i is None, i or 0, hashlib.sha256(base_spans(t or "").encode()).hexdigest()) for i, t in rows]
    assert got == sorted(sums)


def spans(spark, text):
    (row,) = pii.find(texts(spark, [(1, text)])).collect()
    return [(s.kind, text[s.start : s.end], s.score) for s in row.spans]


def test_account_numbers_and_context(spark):
    assert spans(spark, "iban GB82 WEST 1234 5698 7654 32.") == [("iban", "GB82 WEST 1234 5698 7654 32", 1.0)]
    assert spans(spark, "GB82 WEST 1234 5698 7654 33") == []
    ((_, _, plain),), ((_, _, near),) = spans(spark, "x 10.0.0.1"), spans(spark, "host address 10.0.0.1")
    assert near > plain


def test_account_numbers_before_capitals_and_digits(spark):
    plain, cut = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    followers = ["", ".", " Bitte zahlen", " Thank you", " OK", " 5 Euro", " BITTE ZAHLEN SIE", "\nBitte", " A", ", EUR 5", " 2024-01-01", " GB82", "-X"]
    rows = [(2 * i + k, f"an {number}{behind}") for i, behind in enumerate(followers) for k, number in enumerate((plain, cut))]
    found = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "iban"] for r in pii.find(texts(spark, rows)).collect()}
    assert found == {i: [(3, 3 + len((plain, cut)[i % 2]))] for i, _ in rows}
    # Numbers side by side, behind what looks like the start of one, and what is none.
    other = "GB82 WEST 1234 5698 7654 32"
    several = [f"{plain} {other} {cut}", f"AB12 {cut} Bitte", f"{cut} {plain}", f"{plain}Thank", f"x{plain}", f"{cut}1 OK", "NO9386011117947 Takk"]
    expected = [[plain, other, cut], [cut], [cut, plain], [], [], [], ["NO9386011117947"]]
    got = {r.doc_id: [r.text[s.start : s.end] for s in r.spans if s.kind == "iban"] for r in pii.find(texts(spark, list(enumerate(several)))).collect()}
    assert got == dict(enumerate(expected))
    docs = spark.createDataFrame([(1, f"😀 {cut} Bitte {plain} OK")], "doc_id long, text string")
    assert pii.mask(docs).first().text == "😀 [IBAN] Bitte [IBAN] OK"


def test_context_decides_on_both_sides(spark):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    given = [f'token = "{key}"', f"x {key} y", f"{key} is the secret", f"commit {key}", f"token of commit {key}", f"{key}9 key " + "x" * 60 + f" {key}"]
    given += [f"key {key * 6}", "key aaaaaaaaaaaaaaaaaaaaaaaa", "key 12345678901234567890123", f"key é{key}é", f"key {key} {key}", "sk_live-" + key + " auth"]
    expected = [[key], [], [key], [], [], [key + "9"], [], [], [], [key], [key], ["sk_live-" + key]]
    got = {r.doc_id: [r.text[s.start : s.end] for s in r.spans if s.kind == "secret"] for r in pii.find(texts(spark, list(enumerate(given)))).collect()}
    # Context reaches up to the next match, so the second key of the last but one has none.
    assert got == dict(enumerate(expected))
    (row,) = pii.digest(pii.find(texts(spark, [(1, f"host 10.0.0.1, version 10.0.0.2, pwd: {key}")]))).collect()
    assert (row.n_ip, row.n_secret, row.n_spans) == (2, 1, 3)
    high, low, secret = map(float, row.scores.split(","))
    assert high >= low and secret == 0.6
    everything = pii.find(texts(spark, [(1, f"x {key} y")]), min_score=0.0).first().spans
    assert [s.kind for s in everything] == ["secret"]


def test_masks_whatever_the_names(spark):
    docs = spark.createDataFrame([(1, "a@b.cc", "s", "m", "d", 6)], "doc_id long, text string, spans string, masked string, doc string, n_chars int")
    left = pii.mask(docs)
    assert left.schema == docs.schema or left.dtypes == docs.dtypes
    assert tuple(left.first()) == (1, "[EMAIL]", "s", "m", "d", 7)


def test_masks(spark):
    rows = [(1, "write a@b.cc or +49 151 2345678, 😀 4111 1111 1111 1111."), (2, "nothing"), (3, None), (4, "")]
    docs = spark.createDataFrame([(i, t, 7, "k") for i, t in rows], "doc_id long, text string, n_chars long, spans string")
    got = {row.doc_id: (row.text, row.n_chars, row.spans) for row in pii.mask(docs).collect()}
    masked = "write [EMAIL] or [PHONE], 😀 [CARD]."
    assert got == {1: (masked, len(masked), "k"), 2: ("nothing", 7, "k"), 3: (None, 7, "k"), 4: ("", 7, "k")}


def test_no_python_in_native_queries(spark, sf):
    for query in (queries.op2_pii, queries.op10_quality):
        plan = query(spark, sf)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_base_features(spark):
    rng = random.Random(6)
    parts = ["a", "b", "the", "\n", " ", "  ", "\t", "#|", "é😀", "a b c\n", " x\n", "\x1c", "\xa0"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.choice([1, 3, 10, 40, 200])))) for i in range(500)]
    rows += [(9000, None), (9001, ""), (9002, "a " * 3000), (None, "a a a a"), (7, rows[7][1])]
    trusted = spark.createDataFrame([(i,) for i in range(0, 500, 3)] + [(3,)], "doc_id long")
    got = quality.judge(texts(spark, rows), trusted).collect()
    assert len(got) == len(rows)
    expected = sorted(((i is None, i or 0), *counts(t or "")) for i, t in rows)
    assert expected == sorted(((r.doc_id is None, r.doc_id or 0), *tuple(r)[1:6]) for r in got)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_scores_are_means_of_log_ratios(spark):
    docs = texts(spark, [(1, "a b a"), (2, "a c"), (3, ""), (4, None)])
    trusted = spark.createDataFrame([(1,)], "doc_id long")
    table = quality.bucket_counts(docs, trusted, buckets=64)
    assert {(r.raw, r.target) for r in table.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()} == {(8, 5)}
    ratios = quality.log_ratios(table, 64)
    grams = {r.doc_id: r.g for r in quality.base_features(docs).select("doc_id", quality.buckets_of("hashes", 64).alias("g")).collect()}
    for r in quality.judge(docs, trusted, buckets=64).collect():
        places = grams[r.doc_id]
        assert abs(r.score - (sum(ratios[p] for p in places) / len(places) if places else 0)) < 1e-8


def test_quality_without_documents_or_labels(spark):
    nobody = spark.createDataFrame([], "doc_id long")
    assert quality.judge(texts(spark, []), nobody).count() == 0
    (row,) = quality.judge(texts(spark, [(1, "one two " * 30 + " ".join(map(str, range(90))))]), nobody).collect()
    assert row.score == 0 and row.kept


def test_good_documents_stay(spark):
    """Learned from the labels of even ids, measured on those of odd ones."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    judged = quality.judge(docs, labels.filter("quality = 1 AND doc_id % 2 = 0"))
    got = judged.join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("NOT base_failed")
    good, bad = (got.filter(f"quality = {kind}").agg(F.avg(F.col("kept").cast("int"))).first()[0] for kind in (1, 0))
    assert good > 0.99 and bad < 0.2


def test_a_filter_on_the_verdict_is_not_worked_again(spark, sf):
    judged = queries.op10_quality(spark, sf)

    def cuts(rows):
        return rows._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all")

    assert cuts(judged) > 0
    assert cuts(judged.filter("kept")) == cuts(judged.filter("NOT base_failed AND score > 0")) == cuts(judged)
