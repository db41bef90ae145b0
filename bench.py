"""Time the headline queries and print one JSON line.

Each query writes its whole result to a sink that discards it: once to warm up,
then three times; the median counts. Queries with state of their own in a folder
start from a new folder each time.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from driftline.queries import QUERIES

HEADLINE = [
    "forward_edges",
    "relation_matrix_long",
    "graph_nodes",
    "top_edges",
    "latest_posts",
    "message_records",
    "snowball_relations",
    "word_frequency",
    "word_cooccurrence",
    "word_centrality",
    "topic_corpus",
    "topic_keywords",
    "topic_terms",
    "topics_over_time",
    "lda_topics",
    "keyword_counts",
    "relation_matrix_tiles",
    "message_word_centrality",
    "message_term_freq",
    "message_zipf",
    "gulpease",
    "stream_collect",
    "stream_dedup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in HEADLINE:
        seconds(name)
        times[name] = round(statistics.median(seconds(name) for _ in range(3)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
