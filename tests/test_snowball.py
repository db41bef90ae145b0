from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from driftline.operators import snowball
from driftline.sinks import files

CHANNEL = "channel_id long, username string, title string, participants_count long, broadcast int, megagroup int, verified int, scam int, fake int"
POST = "channel_id long, message_id long, date timestamp, is_forwarded boolean, from_id long, from_name string"


def world(spark):
    """a -> b -> c -> d -> a, and c forwards from an unknown channel and an old post."""
    channels = [(i, name, name.upper(), None, 1, None, 0, 0, 0) for i, name in enumerate(["a", "b", "c", "d", "e"], 1)]
    day = [datetime(2024, 1, n) for n in range(1, 10)]
    posts = [
        (1, 10, day[5], True, 2, None),
        (1, 11, day[6], False, 5, None),
        (2, 20, day[5], True, 3, None),
        (3, 30, day[5], True, 4, None),
        (3, 31, day[6], True, 99, "Lost"),
        (3, 29, day[0], True, 5, None),
        (4, 40, day[5], True, 1, None),
        (4, 41, day[6], True, 4, None),
    ]
    return spark.createDataFrame(posts, POST), spark.createDataFrame(channels, CHANNEL)


def sample(spark, refs, **options):
    posts, channels = world(spark)
    seeds = spark.createDataFrame([(r,) for r in refs], "ref string")
    return snowball.snowball(posts, channels, seeds, posts_per_channel=2, **options)


def test_levels(spark):
    found = sample(spark, ["@a", "https://t.me/a", "ghost"], max_depth=2)
    assert rows(found.channels, "username", "discovered_depth", "is_seed", "resolution_status") == [
        ("a", 0, 1, "ok"), ("b", 1, 0, "ok"), ("c", 2, 0, "ok"), ("d", 3, 0, "ok"), ("ghost", 0, 1, "seed_unresolved"),
    ]
    assert rows(found.relations, "channel_to_username", "channel_from_id", "channel_from_username", "from_name_fallback", "sampling_depth") == [
        ("a", 2, "b", "", 0), ("b", 3, "c", "", 1), ("c", 4, "d", "", 2), ("c", 99, "", "Lost", 2),
    ]
    assert rows(snowball.snowball_summary(found)) == [(5, 2, 3, 4)]


def test_cycle_ends(spark):
    found = sample(spark, ["a"], max_depth=50)
    assert rows(found.channels, "username", "discovered_depth") == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]
    assert found.relations.count() == 6


def test_seed_by_id_and_depth_zero(spark):
    found = sample(spark, ["3"], max_depth=0)
    assert rows(found.channels, "username", "discovered_depth") == [("c", 0), ("d", 1)]
    assert rows(found.channels.filter("username = 'c'"), "participants_count", "broadcast", "megagroup") == [(0, 1, 0)]


def test_resume_goes_on_from_the_deepest_level(spark):
    posts, channels = world(spark)
    earlier = sample(spark, ["a"], max_depth=1).channels
    found = snowball.resume(earlier, posts, channels, max_depth=5, posts_per_channel=2)
    assert rows(found.channels, "username", "discovered_depth", "is_seed") == [("c", 2, 1), ("d", 3, 0)]
    assert rows(found.relations, "channel_to_username", "sampling_depth") == [("c", 2), ("c", 2), ("d", 3), ("d", 3)]


def test_resume_seeds(spark):
    earlier = spark.createDataFrame([("a", 2), ("a", 1), ("nan", 0), (None, 9), ("", 9), ("b", 3)], "username string, discovered_depth int")
    assert rows(snowball.resume_seeds(earlier)) == [("a", 1, 3), ("b", 3, 3)]


def test_only_the_newest_posts_count(spark):
    posts, _ = world(spark)
    kept = snowball.newest_forwards(posts, 1)
    assert rows(kept, "channel_id", "message_id") == [(2, 20), (3, 31), (4, 41)]
    assert kept.filter(F.col("channel_id") == 1).count() == 0


def compared(found):
    return rows(found.channels.drop("date_collected_utc")), rows(found.relations), rows(found.seeds)


def test_a_run_stopped_at_any_level_goes_on(spark, tmp_path):
    posts, channels = world(spark)
    seeds = spark.createDataFrame([("@a",), ("ghost",)], "ref string")
    options = {"max_depth": 2, "posts_per_channel": 2}
    expected = compared(snowball.snowball(posts, channels, seeds, **options))
    assert compared(snowball.snowball_logged(posts, channels, seeds, str(tmp_path / "whole"), **options)) == expected
    for last in (0, 1, 2, 3):
        log = str(tmp_path / f"{last}")
        part = snowball.snowball_logged(posts, channels, seeds, log, last_level=last, **options)
        assert part.relations.count() <= len(expected[1])
        stamps = {r.channel_id: r.date_collected_utc for r in part.channels.collect()}
        # No posts: what goes on can only come from the levels that were kept.
        found = snowball.snowball_logged(posts.limit(0), channels, seeds, log, **options)
        assert compared(found) == expected
        assert stamps.items() <= {r.channel_id: r.date_collected_utc for r in found.channels.collect()}.items()


@pytest.mark.parametrize("broken", range(0, 11, 2))
def test_a_run_that_fails_at_any_table_goes_on(spark, tmp_path, monkeypatch, broken):
    posts, channels = world(spark)
    seeds = spark.createDataFrame([("a",)], "ref string")
    options = {"max_depth": 2, "posts_per_channel": 2}
    written = []

    def fails(session, path, rows_of):
        if len(written) == broken:
            # Half a table: files, but no mark of their end.
            rows_of().write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
            raise RuntimeError("lost")
        written.append(path)
        return files.once(session, path, rows_of)

    monkeypatch.setattr(snowball, "once", fails)
    with pytest.raises(RuntimeError):
        snowball.snowball_logged(posts, channels, seeds, str(tmp_path), **options)
    monkeypatch.setattr(snowball, "once", files.once)
    found = snowball.snowball_logged(posts, channels, seeds, str(tmp_path), **options)
    assert compared(found) == compared(snowball.snowball(posts, channels, seeds, **options))


def test_no_seed_is_known(spark, tmp_path):
    posts, channels = world(spark)
    seeds = spark.createDataFrame([("ghost",)], "ref string")
    found = snowball.snowball_logged(posts, channels, seeds, str(tmp_path))
    assert compared(found) == compared(snowball.snowball(posts, channels, seeds))
