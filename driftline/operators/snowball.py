"""Level-by-level discovery of channels over forwards."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.clean import channel_ref, clean_cell, flag
from driftline.operators.joins import lookup_join
from driftline.operators.messages import latest_posts
from driftline.schemas import CHANNELS
from driftline.session import stage
from driftline.sinks.files import once

DEFAULT_MAX_DEPTH = 3
DEFAULT_POSTS = 100


@dataclass(frozen=True)
class Sample:
    """Result of a run: channel records, relation rows and the seeds as given."""

    channels: DataFrame
    relations: DataFrame
    seeds: DataFrame


def resume_seeds(channels: DataFrame) -> DataFrame:
    """Named channels of all earlier runs at their smallest depth, with the greatest depth of all."""
    named = (
        channels.select(clean_cell(F.col("username")).alias("username"), "discovered_depth")
        .filter(F.col("username").isNotNull())
        .groupBy("username")
        .agg(F.min("discovered_depth").alias("discovered_depth"))
    )
    deepest = named.agg(F.max("discovered_depth")).scalar()
    return named.withColumn("previous_depth", deepest)


def newest_forwards(posts: DataFrame, posts_per_channel: int) -> DataFrame:
    """The forwarded ones among the newest posts of each channel, without their text."""
    narrow = posts.select("channel_id", "message_id", "date", "is_forwarded", "from_id", "from_name")
    return latest_posts(narrow, posts_per_channel).filter("is_forwarded").drop("rank", "is_forwarded")


def resolve(refs: DataFrame, channels: DataFrame) -> DataFrame:
    """Add ``channel_id`` to bare references: the channel of that name or that id, else NULL."""
    names = F.array(clean_cell(F.col("username")), F.col("channel_id").cast("string"))
    known = channels.select(F.explode(names).alias("ref"), "channel_id").filter(F.col("ref").isNotNull())
    ids = refs.select("ref").distinct().join(known, "ref").groupBy("ref").agg(F.min("channel_id").alias("channel_id"))
    return refs.join(ids, "ref", "left")


def _expand(start: DataFrame, seen: DataFrame, forwards: DataFrame, known: DataFrame, first: int, last: int) -> DataFrame:
    """All channels reached from ``start`` with their depth: (channel_id, depth).

    One round per level, each ended by a checkpoint. The driver only learns
    whether the new level is empty.
    """
    reached = start.withColumn("depth", F.lit(first))
    frontier = reached
    for depth in range(first, last + 1):
        origins = forwards.join(frontier.select("channel_id"), "channel_id", "left_semi").select("from_id").distinct()
        fresh = (
            origins.select(F.col("from_id").alias("channel_id"))
            .join(known, "channel_id", "left_semi")
            .join(seen, "channel_id", "left_anti")
            .join(reached, "channel_id", "left_anti")
            .withColumn("depth", F.lit(depth + 1))
        )
        frontier = stage(fresh)
        if frontier.isEmpty():
            break
        reached = stage(reached.unionByName(frontier))
    return reached


def channel_records(reached: DataFrame, channels: DataFrame) -> DataFrame:
    """Channel table rows of resolved channels; ``reached`` has channel_id, depth, is_seed."""
    found = channels.join(reached, "channel_id")
    return found.select(
        "channel_id",
        F.coalesce("username", F.lit("")).alias("username"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.col("is_seed").cast("int").alias("is_seed"),
        F.col("depth").cast("int").alias("discovered_depth"),
        F.coalesce(F.col("participants_count").cast("long"), F.lit(0)).alias("participants_count"),
        *[flag(F.col(name)).alias(name) for name in ("broadcast", "megagroup", "verified", "scam", "fake")],
        F.current_timestamp().alias("date_collected_utc"),
        F.lit("ok").alias("resolution_status"),
    )


def unresolved_records(refs: DataFrame) -> DataFrame:
    """Channel table rows of seeds that name no known channel."""
    fixed = {"title": "", "is_seed": 1, "resolution_status": "seed_unresolved"}
    numbers = ("discovered_depth", "participants_count", "broadcast", "megagroup", "verified", "scam", "fake")
    values = {
        "channel_id": F.lit(None),
        "username": F.col("ref"),
        "date_collected_utc": F.current_timestamp(),
        **{name: F.lit(0) for name in numbers},
        **{name: F.lit(value) for name, value in fixed.items()},
    }
    return refs.select(*[values[field.name].cast(field.dataType).alias(field.name) for field in CHANNELS.fields])


def relation_rows(forwards: DataFrame, scanned: DataFrame, channels: DataFrame) -> DataFrame:
    """Relation table rows for the forwards of all scanned channels (channel_id, depth)."""
    names = channels.select("channel_id", "username", "title")
    origin = names.select(
        F.col("channel_id").alias("from_id"),
        F.col("username").alias("from_username"),
        F.col("title").alias("from_title"),
        F.lit(True).alias("resolved"),
    )
    # Every channel is scanned once, so one join gives the relations of all levels.
    scanned_names = names.join(scanned, "channel_id")
    named = lookup_join(forwards.join(scanned_names, "channel_id"), origin, "from_id")
    blank = F.lit("")
    return named.select(
        F.col("channel_id").alias("channel_to_id"),
        F.coalesce("username", blank).alias("channel_to_username"),
        F.coalesce("title", blank).alias("channel_to_title"),
        F.col("from_id").alias("channel_from_id"),
        F.coalesce("from_username", blank).alias("channel_from_username"),
        F.coalesce("from_title", blank).alias("channel_from_title"),
        F.when(F.col("resolved"), blank).otherwise(F.coalesce("from_name", blank)).alias("from_name_fallback"),
        F.col("message_id").alias("target_message_id"),
        F.col("date").alias("target_message_date_utc"),
        F.col("depth").cast("int").alias("sampling_depth"),
    )


def _sample(start, seen, forwards, channels, unresolved, seeds, first, max_depth) -> Sample:
    known = channels.select("channel_id")
    reached = _expand(start, seen, forwards, known, first, max_depth)
    flagged = reached.withColumn("is_seed", (F.col("depth") == first).cast("int"))
    scanned = reached.filter(F.col("depth") <= max_depth)
    return Sample(
        channels=channel_records(flagged, channels).unionByName(unresolved_records(unresolved)),
        relations=relation_rows(forwards, scanned, channels),
        seeds=seeds,
    )


def snowball(
    posts: DataFrame,
    channels: DataFrame,
    seeds: DataFrame,
    *,
    max_depth: int = DEFAULT_MAX_DEPTH,
    posts_per_channel: int = DEFAULT_POSTS,
) -> Sample:
    """Breadth-first sample from ``seeds`` (one text column, ``ref``).

    Channels up to ``max_depth`` are scanned; the origins they forward from are
    recorded one level deeper. Depth is the number of forwards from a seed.
    """
    forwards = stage(newest_forwards(posts, posts_per_channel))
    refs = seeds.select(channel_ref(F.col("ref")).alias("ref")).filter(F.col("ref") != "").distinct()
    resolved = stage(resolve(refs, channels))
    start = resolved.filter(F.col("channel_id").isNotNull()).select("channel_id").distinct()
    unresolved = resolved.filter(F.col("channel_id").isNull())
    return _sample(start, start.limit(0), forwards, channels, unresolved, refs, 0, max_depth)


def snowball_logged(
    posts: DataFrame,
    channels: DataFrame,
    seeds: DataFrame,
    log: str,
    *,
    max_depth: int = DEFAULT_MAX_DEPTH,
    posts_per_channel: int = DEFAULT_POSTS,
    last_level: int | None = None,
) -> Sample:
    """``snowball`` that keeps every level in a folder ``log`` as it is done, and goes on there when called again.

    The forwards are taken from the posts once. A level writes its channels, their
    relations and the channels found for the next one, each table under its number;
    tables that are whole are read, not worked again, so no channel is scanned
    twice. Call it again with the same posts, seeds and bounds. ``last_level``
    ends the run early, with what is there by then.
    """
    spark = posts.sparkSession
    known = channels.select("channel_id")

    def kept(name: str, rows) -> DataFrame:
        return once(spark, f"{log}/{name}", rows)

    refs = seeds.select(channel_ref(F.col("ref")).alias("ref")).filter(F.col("ref") != "").distinct()
    resolved = kept("seeds", lambda: resolve(refs, channels))
    forwards = kept("forwards", lambda: newest_forwards(posts, posts_per_channel))
    start = resolved.filter(F.col("channel_id").isNotNull()).select("channel_id").distinct()
    level = kept("reached/level=0", lambda: start)
    found = kept("channels/unresolved", lambda: unresolved_records(resolved.filter(F.col("channel_id").isNull())))
    relations, seen, depth = None, level, 0
    while not level.isEmpty():
        at = level.select("channel_id", F.lit(depth).alias("depth"))
        flagged = at.withColumn("is_seed", F.lit(int(depth == 0)))
        found = found.unionByName(kept(f"channels/level={depth}", lambda: channel_records(flagged, channels)))
        if depth > max_depth or (last_level is not None and depth > last_level):
            break
        rows = kept(f"relations/level={depth}", lambda: relation_rows(forwards, at, channels))
        relations = rows if relations is None else relations.unionByName(rows)
        origins = forwards.join(level, "channel_id", "left_semi").select(F.col("from_id").alias("channel_id")).distinct()
        fresh = origins.join(known, "channel_id", "left_semi").join(seen, "channel_id", "left_anti")
        level, depth = kept(f"reached/level={depth + 1}", lambda: fresh), depth + 1
        seen = seen.unionByName(level)
    if relations is None:
        relations = relation_rows(forwards, level.select("channel_id", F.lit(0).alias("depth")), channels)
    return Sample(found, relations, resolved.select("ref").distinct())


def resume(
    earlier: DataFrame,
    posts: DataFrame,
    channels: DataFrame,
    *,
    max_depth: int = DEFAULT_MAX_DEPTH,
    posts_per_channel: int = DEFAULT_POSTS,
) -> Sample:
    """Go on from the channel tables of earlier runs.

    Scanning starts at the greatest depth they hold; shallower channels count as
    visited and are neither scanned nor recorded again.
    """
    forwards = stage(newest_forwards(posts, posts_per_channel))
    earlier = resume_seeds(earlier).withColumn("ref", channel_ref(F.col("username")))
    resolved = stage(resolve(earlier, channels))
    first = resolved.agg(F.max("previous_depth")).first()[0]
    at_start = F.col("discovered_depth") == F.lit(first)
    start = resolved.filter(at_start & F.col("channel_id").isNotNull()).select("channel_id").distinct()
    seen = resolved.filter(~at_start & F.col("channel_id").isNotNull()).select("channel_id").distinct()
    unresolved = resolved.filter(at_start & F.col("channel_id").isNull())
    seeds = resolved.filter(at_start).select("ref").distinct()
    return _sample(start, seen, forwards, channels, unresolved, seeds, first or 0, max_depth)


def snowball_summary(sample: Sample) -> DataFrame:
    """Channels in all, seeds, channels found beyond them, and relations."""
    relations = sample.relations.agg(F.count(F.lit(1))).scalar()
    seeds = sample.seeds.agg(F.count(F.lit(1))).scalar()
    return sample.channels.agg(F.count(F.lit(1)).alias("total_channels")).select(
        "total_channels",
        seeds.alias("seeds"),
        (F.col("total_channels") - seeds).alias("discovered"),
        relations.alias("relations"),
    )
