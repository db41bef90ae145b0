"""Near copies, repeated passages and components against brute force."""

import random
import re

import numpy as np
import pytest

from driftline.llm import components, jaccard, queries, substrings
from .conftest import texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def least(links, nodes):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    for links in ([(i, i + 1) for i in range(60)], [(rng.randrange(90), rng.randrange(90)) for _ in range(70)], [(7, i) for i in range(50)], [(3, 3)], []):
        got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
        real = [link for link in links if link[0] != link[1]]
        assert got == least(real, {n for link in real for n in link})


def brute_components(rows, length, percent):
    sets = {}
    for doc, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc] = {tuple(words[i : i + length]) for i in range(len(words) - length + 1)} or ({tuple(words)} if words else set())
    ids = sorted(sets)
    links = []
    for a in ids:
        for b in ids:
            if b < a and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    links.append((a, b))
    found = least(links, ids)
    return sorted((doc, len(sets[doc]), found[doc]) for doc, _ in rows)


def edited(rng, n):
    common = "the of a in to is it on".split()
    base = [[rng.choice(common + [f"w{rng.randrange(300)}" for _ in range(6)]) for _ in range(rng.choice([5, 12, 30, 60, 90]))] for _ in range(10)]
    rows = []
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            at, kind = rng.randrange(len(words)), rng.random()
            if kind < 0.5:
                words[at] = f"x{rng.randrange(50)}"
            elif kind < 0.75:
                words.insert(at, "The")
            elif len(words) > 1:
                del words[at]
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
    return rows


@pytest.mark.parametrize("length, percent", [(3, 90), (5, 80), (1, 50)])
def test_near_duplicates(spark, length, percent):
    rows = edited(random.Random(length), 260) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "a"), (1004, "A"), (1005, "a b"), (1005, "a b")]
    got = jaccard.near_duplicates(texts(spark, rows), length=length, percent=percent).collect()
    assert sorted(map(tuple, got)) == brute_components(rows, length, percent)


def test_chain_beyond_the_centre(spark):
    """Each text is like the next, the ends are unlike: one component, though few are like the centre."""
    words = [f"w{i}" for i in range(90)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 40])) for i in range(16)]
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(texts(spark, rows), length=1, percent=80).collect()}
    assert got == {doc: found for doc, _, found in brute_components(rows, 1, 80)} and len(set(got.values())) < 5


def test_rows_without_id(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (4, "a b c d"), (9, "a b c d")]
    got = sorted(map(str, jaccard.near_duplicates(texts(spark, rows), length=3, percent=90).toDF("d", "n", "c").collect()))
    assert got == sorted(["Row(d=None, n=2, c=None)"] * 2 + ["Row(d=4, n=2, c=4)", "Row(d=9, n=2, c=4)"])


def test_nothing(spark):
    assert jaccard.near_duplicates(texts(spark, []), length=3, percent=90).count() == 0
    assert substrings.dedup(texts(spark, []), window=5).count() == 0


def test_op6_on_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op6_jaccard(spark, sf).collect())) == brute_components(rows, 3, 90)


def brute_removal(rows, window):
    places, cut = {}, [WORD.findall(text or "") for _, text in rows]
    for row, words in enumerate(cut):
        for i in range(len(words) - window + 1):
            places.setdefault(tuple(words[i : i + window]), []).append((row, i))
    gone = [set() for _ in rows]
    for spots in places.values():
        if len(spots) > 1:
            for row, i in spots:
                gone[row].update(range(i, i + window))
    return sorted(
        (str(rows[row][0]), len(words), len(gone[row]), " ".join(w for i, w in enumerate(words) if i not in gone[row])) for row, words in enumerate(cut)
    )


@pytest.mark.parametrize("window, bucket", [(10, 256), (10, 2), (3, 4), (35, 1)])
def test_dedup(spark, window, bucket):
    rng = random.Random(window)
    base = [[f"w{rng.randrange(30)}" for _ in range(rng.choice([5, 12, 30, 60]))] for _ in range(12)]
    rows = []
    for i in range(250):
        parts = [list(rng.choice(base)) if rng.random() < 0.5 else [f"u{rng.randrange(9999)}" for _ in range(9)] for _ in range(3)]
        words = sum(parts, [])
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(len(words))] = f"é{rng.randrange(50)}"
        rows.append((i, rng.choice([" ", "\n", " \x0b"]).join(words)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "a"), (1004, "und " * 100), (1005, "und " * 12)]
    rows += [(5, rows[5][1]), (None, rows[7][1]), (None, "q r s")]
    got = substrings.dedup(texts(spark, rows), window=window, bucket_strings=bucket).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == brute_removal(rows, window)


def test_op7_on_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = [(str(r[0]), *r[1:]) for r in substrings.dedup(spark.read.parquet(f"{sf}/documents.parquet"), window=35).collect()]
    assert sorted(got) == brute_removal(rows, 35)
    assert queries.op7_substrings(spark, sf).columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]


def test_one_row_of_each_component(spark):
    """Shared ids, rows given twice and rows without an id are told apart by their texts."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = a.replace("a30", "changed")
    rows = [(1, a), (1, a), (2, a), (None, a), (None, a), (5, near + " end"), (5, b), (None, c), (None, c), (7, None), (7, None), (8, ""), (8, "")]
    docs = texts(spark, rows).withColumnRenamed("score", "sum").withColumnRenamed("size", "first").withColumnRenamed("ids", "row")
    left = jaccard.one_of_each(docs, length=5, percent=80)
    assert left.schema == docs.schema
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([(1, a), (5, b), (None, c), (7, None), (7, None), (8, ""), (8, "")], key=str)


def test_one_of_each_against_brute_force(spark):
    rng = random.Random(21)
    rows = edited(rng, 150)
    rows = [(rng.choice([i, i, i // 2, None]), text) for i, text in rows]
    rows += rng.choices(rows, k=40)
    left = sorted(((r.doc_id, r.text) for r in jaccard.one_of_each(texts(spark, rows), length=5, percent=80).collect()), key=str)
    by_row = brute_components([(i, text) for i, (_, text) in enumerate(rows)], 5, 80)
    groups = {}
    for row, size, component in by_row:
        groups.setdefault(component if size else (row, "empty"), []).append(rows[row])
    # The least id stays; where texts share it, any one of those.
    least = {g: min(((i is None, i or 0) for i, _ in members)) for g, members in groups.items()}
    assert len(left) == len(groups)
    allowed = list(sorted({(i, t) for i, t in members if (i is None, i or 0) == least[g]}, key=str) for g, members in groups.items())
    for row in left:
        assert any(row in group for group in allowed)
    for group in groups.values():
        assert any(row in group for row in left)


def test_first_minima():
    rng = np.random.default_rng(4)
    for n, span, kinds in [(1, 1, 1), (5, 5, 2), (40, 2, 9), (40, 3, 3), (100, 31, 50), (64, 32, 5), (33, 33, 3), (300, 31, 1), (300, 31, 10**9)]:
        values = rng.integers(0, kinds, n).astype(np.uint64)
        views = np.lib.stride_tricks.sliding_window_view(values, span)
        assert substrings.first_minima(values, span).tolist() == (views.argmin(axis=1) + np.arange(len(views))).tolist()


def test_packed_runs_cover_every_window_once():
    rng = np.random.default_rng(9)
    for kinds, n in [(1, 5000), (2, 3000), (500, 4000), (9, 35), (9, 34), (9, 0)]:
        hashes = rng.integers(0, kinds, n).astype(np.uint64)
        begins, sizes, _ = substrings.packed_runs(hashes, 35, 5)
        assert [i for begin, size in zip(begins, sizes) for i in range(begin, begin + size)] == list(range(max(0, n - 34)))
