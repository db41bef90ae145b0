"""The corpus pipeline: stages over documents, each written and read again before the next.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given; all but
the last return the columns they got.

1. language     rows whose text has no language go: NULL, or without a letter
2. near copies  of each component of rows that share 80 % of their five-word shingles,
                the one with the least id stays, whatever ids the others have
3. benchmark    rows that hold a test item, whole or edited, go
4. personal     every confirmed span is replaced by its kind in brackets, n_chars
                follows; NULL texts stay NULL
5. tokens       the ids of each text, their number, and digests of them and of
                the text they decode to
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import bpe, decontaminate, jaccard, langid, pii
from driftline.llm.files import kept
from driftline.llm.ship import ship

# Texts on their way to Python at a time, and their bytes.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def ready(spark: SparkSession) -> None:
    """The package is with the workers, and batches are bounded from here on, as stages give plans that run later."""
    ship(spark)
    for name, value in BATCH.items():
        spark.conf.set(name, value)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a letter or a text go; the others stay, in any number, with all columns. No rows, no rows."""
    ready(spark)
    model = langid.learn(docs)
    if not model.families.names:
        # No language was learned, so none can be told apart; what is rejected stays the same.
        return langid.with_letters(docs)
    names = _unused(docs, "predicted", "score")
    predicted = langid.predict(docs, model, keep=docs.columns, lang_name=names[0], score_name=names[1])
    return predicted.filter(F.col(names[0]) != langid.UNDETERMINED).select(*docs.columns)


def _unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, longer where the table has them already, in any case."""
    taken = max((len(name) for name in docs.columns), default=0)
    return [name if name not in map(str.lower, docs.columns) else name + "_" * taken for name in names]


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays, of equal rows any one; rows without an id, or with one id, are told apart by their texts."""
    ready(spark)
    return jaccard.one_of_each(docs, length=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a test item go, each judged for itself; NULL and empty texts hold none. No items, all stay."""
    ready(spark)
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays, its text masked; NULL and empty texts as they are."""
    ready(spark)
    return pii.mask(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per row; NULL texts count as empty ones and have no ids."""
    ready(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    decoded = bpe.decode(bpe.encode(docs, path), path)
    return bpe.digest(decoded)


STAGES = [
    ("language", language),
    ("near copies", near_copies),
    ("benchmark", benchmark),
    ("personal", personal),
    ("tokens", tokens),
]
# Learned languages, alignments and merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
