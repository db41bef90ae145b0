"""Topic job: message files in; keywords, topics and topics over time out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftline.functions.stopwords import TOPIC_LANGUAGES, stop_words
from driftline.operators import topics
from driftline.session import stage
from driftline.sinks.files import run_stamp, write_csv
from driftline.sources.tables import read_messages


def run(
    spark: SparkSession,
    messages: str,
    output: str,
    *,
    languages=TOPIC_LANGUAGES,
    n_topics: int = topics.TOPICS,
    keywords: int = topics.KEYWORDS,
    min_df: float = topics.MIN_DF,
    bins: int = topics.BINS,
    run_id: str | None = None,
) -> dict[str, DataFrame]:
    """Write ``topic_terms``, ``doc_topics`` and ``topics_over_time`` below ``output``."""
    run_id = run_id or run_stamp()
    corpus = stage(topics.topic_corpus(read_messages(spark, messages)))
    cells = stage(
        topics.document_keywords(corpus, stop_words=stop_words(languages), min_df=min_df, n=keywords)
    )
    factors = topics.factorise(cells, topics=n_topics)
    over_time = topics.topics_over_time(cells, factors, topics.time_bins(corpus, bins=bins))
    write_csv(topics.topic_terms(factors), f"{output}/topic_terms", run_id=run_id)
    write_csv(topics.doc_topics(factors), f"{output}/doc_topics", run_id=run_id)
    write_csv(over_time, f"{output}/topics_over_time", run_id=run_id)
    return {
        "top_terms": topics.top_terms(topics.topic_terms(factors)),
        "top_documents": topics.top_documents(topics.doc_topics(factors)),
    }
