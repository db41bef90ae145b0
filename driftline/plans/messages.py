"""Message collection job: posts and channel files in; new messages and a trace out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline import schemas
from driftline.functions.clean import date_bound
from driftline.operators import messages
from driftline.session import stage
from driftline.sinks.files import run_stamp, write_appended, write_csv
from driftline.sources.tables import read_channels, read_csv


def bounds(spark: SparkSession, start: str | None, end: str | None) -> tuple[datetime | None, datetime | None]:
    """Both ends as timestamps; an empty range is an error."""
    row = spark.range(1).select(
        date_bound(F.lit(start), is_end=False).alias("start"),
        date_bound(F.lit(end), is_end=True).alias("end"),
        (date_bound(F.lit(start), is_end=False) > date_bound(F.lit(end), is_end=True)).alias("empty"),
    )
    found = row.first()
    if (start and found.start is None) or (end and found.end is None):
        raise ValueError("dates must be in ISO form")
    if found.empty:
        raise ValueError("the start date is after the end date")
    return found.start, found.end


def run(
    spark: SparkSession,
    posts: DataFrame,
    channels: str,
    output: str,
    *,
    column: str = "username",
    keywords=(),
    start: str | None = None,
    end: str | None = None,
    limit: int | None = messages.DEFAULT_LIMIT,
    resume: bool = False,
    run_id: str | None = None,
) -> dict[str, DataFrame]:
    """Collect messages of the listed channels and append to the trace.

    With ``resume`` channels in the trace of earlier runs are left out.
    ``posts`` has ``channel_username`` besides the message columns.
    """
    if limit is not None and limit <= 0:
        raise ValueError("limit must be above 0")
    run_id = run_id or run_stamp()
    keywords = [word.strip() for word in keywords if word.strip()] or [""]
    first, last = bounds(spark, start, end)

    wanted = stage(messages.channel_list(read_channels(spark, channels), column))
    if wanted.isEmpty():
        raise ValueError("the channel list is empty")
    trace = f"{output}/elaborated_channels"
    if resume:
        done = read_csv(spark, trace, schemas.CHANNEL_TRACE)
        wanted = messages.pending_channels(wanted, done)
    records = stage(
        messages.collect_messages(posts, stage(wanted) if resume else wanted, keywords=keywords, start=first, end=last, limit=limit)
    )
    write_csv(records, f"{output}/messages", run_id=run_id)
    write_appended(messages.channel_trace(records), trace, run_id)
    return {
        "per_channel": messages.messages_per_channel(records),
        "totals": messages.collection_totals(records),
        "top_sources": messages.top_forward_sources(records),
    }
