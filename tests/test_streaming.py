import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from driftline.operators import messages
from driftline.sources import fixtures
from driftline.streaming import collection, generations


def arrive(spark, sf, inbox, half):
    events = fixtures.table(spark, sf, "events")
    events.filter(F.col("event_id") % 2 == half).coalesce(1).write.mode("append").parquet(inbox)


def posts(spark, sf, inbox, **options):
    schema = fixtures.table(spark, sf, "events").schema
    return fixtures.header_posts(collection.message_stream(spark, inbox, schema, **options))


def batch(spark, sf):
    found = fixtures.header_posts(fixtures.table(spark, sf, "events")).filter("text <> ''")
    return messages.message_record(found)


def test_stream_equals_batch_and_restarts_where_it_stopped(spark, sf, tmp_path):
    inbox, target, log = (str(tmp_path / name) for name in ("inbox", "out", "log"))
    counts = []
    for half in (0, 1):
        arrive(spark, sf, inbox, half)
        for _ in range(2):
            collection.append(collection.collected(posts(spark, sf, inbox)), target, log).awaitTermination()
            counts.append(spark.read.parquet(target).count())
    assert counts[0] == counts[1] < counts[2] == counts[3]
    assert rows(spark.read.parquet(target)) == rows(batch(spark, sf))


def test_copies_in_later_batches_are_dropped(spark, sf, tmp_path):
    inbox, target, keys, log = (str(tmp_path / name) for name in ("inbox", "out", "keys", "log"))
    for half in (0, 0, 1, 1):
        arrive(spark, sf, inbox, half)
    records = collection.collected(posts(spark, sf, inbox, files_per_batch=1))
    collection.append_new(records, target, keys, log).awaitTermination()
    assert rows(spark.read.parquet(target).drop("batch")) == rows(batch(spark, sf))


def test_much_older_posts_that_arrive_later_are_kept(spark, tmp_path):
    schema = "channel_username string, message_id long, date timestamp, text string, views long, forwards long, is_forwarded boolean, forward_from_chat string"
    inbox, target, keys, log = (str(tmp_path / name) for name in ("inbox", "out", "keys", "log"))
    for rows_in in ([("b", 1, "2024-06-01")], [("a", 1, "2024-01-01"), ("b", 1, "2024-06-01")], [(None, 1, "2020-01-01")], [(None, 1, "2020-01-01")]):
        given = [(*row, "Some Text", 1, 1, False, None) for row in rows_in]
        plain = spark.createDataFrame(given, schema.replace("date timestamp", "date string"))
        plain.selectExpr(*[f"cast(date as timestamp) date" if name == "date" else name for name in plain.columns]).write.mode("append").parquet(inbox)
        records = spark.readStream.schema(schema).parquet(inbox)
        collection.append_new(records, target, keys, log).awaitTermination()
    found = spark.read.parquet(target).select("channel_username", "message_id").collect()
    assert sorted(map(str, map(tuple, found))) == ["('a', 1)", "('b', 1)", "(None, 1)"]


def test_keywords_of_a_stream(spark, sf, tmp_path):
    inbox, target, log = (str(tmp_path / name) for name in ("inbox", "out", "log"))
    arrive(spark, sf, inbox, 0)
    records = collection.collected(posts(spark, sf, inbox), keywords=["NOT THERE", "1"])
    collection.append(records, target, log).awaitTermination()
    given = fixtures.header_posts(spark.read.parquet(inbox)).filter("text LIKE '%1%'")
    assert spark.read.parquet(target).count() == given.count()


def test_trace_adds_up_over_batches(spark, sf, tmp_path):
    inbox, target, log = (str(tmp_path / name) for name in ("inbox", "out", "log"))
    for half in (0, 1):
        arrive(spark, sf, inbox, half)
        records = collection.collected(posts(spark, sf, inbox))
        collection.append_trace(records, target, log).awaitTermination()
    assert rows(collection.read_trace(spark, target)) == rows(messages.channel_trace(batch(spark, sf)))


@pytest.mark.parametrize("fan", [2, 3, 8])
def test_runs_hold_every_batch_once(fan):
    for batches in range(200):
        runs = generations.live(batches, fan)
        covered = [b for level, number in runs for b in range(number * fan**level, (number + 1) * fan**level)]
        assert covered == list(range(batches))
        assert all(sum(level == k for level, _ in runs) < fan for k in range(10))


def made(spark, n, start=0, channels=5):
    rows = [(f"c{i % channels}", start + i, f"text {i}") for i in range(n)]
    return spark.createDataFrame(rows, "channel_username string, message_id long, text string")


def folders(path):
    return sorted(p.relative_to(path).as_posix() for p in path.glob("level=*/run=*"))


def test_merged_index_finds_every_key_and_is_bounded(spark, tmp_path):
    target, keys = tmp_path / "out", tmp_path / "keys"
    write = collection.first_arrivals(spark, made(spark, 1).schema, str(target), str(keys), buckets=4, fan=2)
    for batch in range(11):
        # Half of each batch was there before, some of it long ago.
        write(made(spark, 20, start=10 * batch).unionByName(made(spark, 3)), batch)
        generations.clear(spark, str(keys), batch + 1, 2)
        assert folders(keys) == sorted(f"level={level}/run={number}" for level, number in generations.live(batch + 1, 2))
    found = spark.read.parquet(str(target)).select("channel_username", "message_id")
    assert found.count() == found.distinct().count()
    expected = made(spark, 20)
    for batch in range(1, 11):
        expected = expected.unionByName(made(spark, 20, start=10 * batch))
    assert rows(found.distinct()) == rows(expected.select("channel_username", "message_id").distinct())


@pytest.mark.parametrize("crashed", [0, 1, 3, 4])
def test_a_batch_run_again_replaces_what_it_wrote(spark, tmp_path, crashed):
    """Also where it had completed merged runs before it failed."""
    target, keys, sums = tmp_path / "out", tmp_path / "keys", tmp_path / "sums"
    write = collection.first_arrivals(spark, made(spark, 1).schema, str(target), str(keys), buckets=4, fan=2)
    trace = collection.trace_batches(spark, str(sums), fan=2)
    for batch in range(6):
        for _ in range(2 if batch == crashed else 1):
            write(made(spark, 20, start=10 * batch), batch)
            trace(made(spark, 20, start=10 * batch), batch)
    assert spark.read.parquet(str(target)).count() == 70
    counted = collection.read_trace(spark, str(sums), fan=2)
    assert rows(counted) == [(f"c{i}", 24) for i in range(5)]
    assert len(counted.inputFiles()) <= 2 * len(generations.live(6, 2))


def test_only_touched_buckets_are_read(spark, tmp_path):
    target, keys = tmp_path / "out", tmp_path / "keys"
    write = collection.first_arrivals(spark, made(spark, 1).schema, str(target), str(keys), buckets=16)
    for batch in range(3):
        write(made(spark, 100, start=100 * batch, channels=40), batch)
    kinds = "channel_username string, message_id long"
    some = collection.stored_keys(spark, str(keys), generations.live(3), kinds, [1, 5])
    assert 0 < len(some.inputFiles()) and some.select("bucket").distinct().count() <= 2
    scan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in scan and "bucket#" in scan.split("PartitionFilters")[1].split("]")[0]


def test_half_written_runs_are_not_read(spark, tmp_path):
    sums = tmp_path / "sums"
    trace = collection.trace_batches(spark, str(sums), fan=2)
    trace(made(spark, 10), 0)
    (sums / "level=0/run=1").mkdir()
    assert rows(collection.read_trace(spark, str(sums), fan=2)) == [(f"c{i}", 2) for i in range(5)]


def test_timed_flush_and_a_last_one(spark, sf, tmp_path):
    inbox, target, keys, log = (str(tmp_path / name) for name in ("inbox", "out", "keys", "log"))
    arrive(spark, sf, inbox, 0)
    flushed = []

    def start(interval):
        return collection.append_new(collection.collected(posts(spark, sf, inbox)), target, keys, log, interval_seconds=interval)

    def stop(query):
        if any(progress["numInputRows"] for progress in query.recentProgress):
            flushed.append(spark.read.parquet(target).count())
            arrive(spark, sf, inbox, 1)
            return True
        return False

    collection.collect_until(start, stop, interval_seconds=1)
    found = rows(spark.read.parquet(target).drop("batch"))
    assert found == rows(batch(spark, sf)) and 0 < flushed[0] < len(found)


def test_a_failed_flush_raises(spark, sf, tmp_path):
    inbox, log = str(tmp_path / "inbox"), str(tmp_path / "log")
    arrive(spark, sf, inbox, 0)

    def start(interval):
        return posts(spark, sf, inbox).writeStream.foreachBatch(lambda rows, _: 1 / 0).option("checkpointLocation", log).trigger(processingTime="1 second").start()

    with pytest.raises(StreamingQueryException):
        collection.collect_until(start, lambda query: False, interval_seconds=1)
