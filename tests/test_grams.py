import math
import random

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from driftline.operators import grams, topics, vocabulary
from driftline.session import stage


@pytest.fixture(scope="module")
def corpus(spark):
    random.seed(3)
    words = [a + b for a in "abcde" for b in "xyzé"]
    texts = [" ".join(random.choices(words, k=random.choice([0, 1, 2, 3, 40]))) for _ in range(60)]
    return stage(spark.createDataFrame(list(enumerate([*texts, "", "1", None])), "doc_id long, text string").repartition(3, "doc_id"))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(grams, "BLOCK_DOCS", 4)
    monkeypatch.setattr(grams, "BLOCK_WORDS", 60)
    monkeypatch.setattr(grams, "TASK_HASHES", 50)


@pytest.mark.parametrize("bound", [1, 5, 0.1])
def test_vocabulary_of_many_blocks_is_that_of_the_plain_count(spark, corpus, small_blocks, bound):
    plain = vocabulary.vocabulary(corpus.select("text"), F.lit(corpus.count()), stop_words=("ax",), min_df=bound)
    assert rows(topics.corpus_vocabulary(corpus, stop_words=("ax",), min_df=bound)) == rows(plain)


def test_keywords_of_many_blocks_are_those_of_all_terms(spark, corpus, small_blocks):
    n_docs = corpus.count()
    vocab = {r.term: r.df for r in vocabulary.vocabulary(corpus.select("text"), F.lit(n_docs), min_df=5).collect()}
    best = {}
    for r in vocabulary.doc_terms(corpus, ["doc_id"]).collect():
        if r.term in vocab:
            best.setdefault(r.doc_id, []).append((-round(r.tf * (math.log((n_docs + 1) / (vocab[r.term] + 1)) + 1), 6), r.term))
    expected = [(d, term, -w, i + 1) for d, found in best.items() for i, (w, term) in enumerate(sorted(found)[:5])]
    assert rows(topics.document_keywords(corpus)) == sorted(expected, key=str)


def test_no_term_of_a_document_is_shuffled_but_its_heaviest(spark, corpus):
    """The terms of a document met the whole vocabulary in a join before."""
    plan = topics.document_keywords(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan


def test_blocks_are_cut_at_their_bounds(monkeypatch):
    monkeypatch.setattr(grams, "BLOCK_WORDS", 3)
    batch = pa.RecordBatch.from_pylist([{"block": b, "words": ["x"] * n} for b, n in [(0, 4), (0, 1), (1, 0), (1, 1)]])
    whole = [(block, [len(w) for w in table.column("words").to_pylist()]) for block, table in grams._blocks(iter([batch, batch.slice(2)]))]
    assert whole == [(0, [4, 1]), (1, [0, 1, 0, 1])]


def test_nothing_in_nothing_out(spark, corpus):
    nothing = stage(corpus.limit(0))
    assert topics.corpus_vocabulary(nothing).count() == topics.document_keywords(nothing).count() == 0


def test_tasks_give_memory_back(monkeypatch):
    """Workers kept what their last task had used."""
    given = []
    monkeypatch.setattr(grams.pa, "default_memory_pool", lambda: type("Pool", (), {"release_unused": lambda self: given.append("back")})())
    assert list(grams.tidied(lambda batches: (batch * 2 for batch in batches))(iter([1, 2]))) == [2, 4]
    assert given == ["back"]
