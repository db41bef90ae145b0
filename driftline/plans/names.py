"""Channel-name job: channel files in; word frequencies, word graph and centralities out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.stopwords import NAME_LANGUAGES, stop_words
from driftline.operators import centrality, names, vocabulary
from driftline.session import stage
from driftline.sinks.files import run_stamp, write_csv, write_graph, write_json
from driftline.sources.tables import read_channels


def run(
    spark: SparkSession,
    channels: str,
    output: str,
    *,
    languages=NAME_LANGUAGES,
    min_df: float = 0.01,
    max_df: float = 0.9,
    top_n: int | None = None,
    min_token_len: int = 2,
    run_id: str | None = None,
) -> dict[str, DataFrame]:
    """Write the result tables below ``output``; return the frequency and centrality tables.

    ``min_token_len`` above 2 and ``top_n``, the number of most frequent terms to
    keep, narrow the vocabulary only where the caller asks for it.
    """
    run_id = run_id or run_stamp()
    rows = read_channels(spark, channels)
    table = names.name_table(rows)
    texts = stage(vocabulary.distinct_texts(table, "name"))
    unwanted = stop_words(languages)
    vocab = vocabulary.vocabulary(
        texts, texts.agg(F.sum("copies")).scalar(), stop_words=unwanted, min_df=min_df, max_df=max_df
    )
    if min_token_len > 2:
        vocab = vocab.filter(~F.exists(F.split("term", " "), lambda word: F.length(word) < min_token_len))
    if top_n:
        vocab = vocab.orderBy(F.desc("frequency"), "term").limit(top_n)
    vocab = stage(vocab)
    pairs = stage(vocabulary.cooccurrence(vocabulary.text_terms(texts, stop_words=unwanted, within=vocab.select("term"))))
    nodes = vocab.select(F.col("term").alias("token"))

    frequency = vocabulary.word_frequency(vocab)
    central = centrality.word_centrality(nodes, pairs)
    fit = stage(names.zipf_fit(names.zipf_table(frequency)))
    write_csv(frequency, f"{output}/word_frequency", run_id=run_id)
    write_csv(central, f"{output}/word_graph_centrality", run_id=run_id)
    write_graph(nodes, pairs.filter("a < b"), f"{output}/word_cooccurrence_graph", run_id=run_id)
    write_json(names.name_summary(rows, names.name_features(table), fit), f"{output}/summary/run_id={run_id}")
    return {"word_frequency": frequency, "centrality": central}
