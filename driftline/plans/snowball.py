"""Snowball sampling job: posts, channels and seeds in; channel and relation files out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators import snowball
from driftline.session import stage
from driftline.sinks.files import run_stamp, write_csv
from driftline.sources.tables import read_channels


def run(
    spark: SparkSession,
    posts: DataFrame,
    channels: DataFrame,
    output: str,
    *,
    seeds=None,
    max_depth: int = snowball.DEFAULT_MAX_DEPTH,
    posts_per_channel: int = snowball.DEFAULT_POSTS,
    run_id: str | None = None,
    log: str | None = None,
) -> DataFrame:
    """Sample from ``seeds``, or without any go on from the channel files of earlier runs.

    With a folder ``log``, levels of a run from seeds are kept there as they are
    done; a run that failed goes on behind its last one when started again.

    Writes one run of ``snowball_channels`` and ``snowball_relations`` below
    ``output`` and returns the summary.
    """
    if max_depth < 0 or posts_per_channel <= 0:
        raise ValueError("max_depth must not be negative and posts_per_channel must be above 0")
    run_id = run_id or run_stamp()
    options = {"max_depth": max_depth, "posts_per_channel": posts_per_channel}
    if seeds:
        refs = spark.range(1).select(F.explode(F.array(*[F.lit(seed) for seed in seeds])).alias("ref"))
        sample = snowball.snowball_logged(posts, channels, refs, log, **options) if log else snowball.snowball(posts, channels, refs, **options)
    else:
        sample = snowball.resume(read_channels(spark, f"{output}/snowball_channels"), posts, channels, **options)
    found = snowball.Sample(stage(sample.channels), stage(sample.relations), sample.seeds)
    write_csv(found.channels, f"{output}/snowball_channels", run_id=run_id)
    write_csv(found.relations, f"{output}/snowball_relations", run_id=run_id)
    return snowball.snowball_summary(found)
