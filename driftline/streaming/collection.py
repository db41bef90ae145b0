"""Incremental message collection: filter, project, de-duplicate, append, trace."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from driftline.operators.messages import in_date_range, message_record
from driftline.streaming import generations

SAVE_INTERVAL_SECONDS = 30


def message_stream(spark: SparkSession, folder: str, schema: StructType, *, files_per_batch: int | None = None, glob: str | None = None) -> DataFrame:
    """Rows of the files that arrive in ``folder``."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(folder)


def collected(posts: DataFrame, *, start=None, end=None, keywords=("",)) -> DataFrame:
    """Message records of the posts with text, within the dates, that hold one of the keywords ('' is in every text)."""
    text = F.coalesce("text", F.lit(""))
    found = F.lit(False)
    for keyword in keywords:
        found = found | F.contains(F.lower(text), F.lower(F.lit(keyword)))
    return message_record(posts.filter((text != "") & in_date_range("date", start, end) & found))


KEY = ["channel_username", "message_id"]


def first_arrivals(spark: SparkSession, records: StructType, target: str, keys: str, *, buckets: int = 64, fan: int = generations.FAN) -> Callable[[DataFrame, int], None]:
    """What ``append_new`` does with each batch, given its rows and its number; a table of ``records`` at ``target``."""
    kinds = ", ".join(f"{name} {records[name].dataType.simpleString()}" for name in KEY)
    bucket = F.pmod(F.xxhash64("channel_username"), F.lit(buckets)).cast("int").alias("bucket")

    def store(index: DataFrame, path: str) -> None:
        # Large buckets are cut into several files, small ones have one.
        dealt = index.hint("rebalance", "bucket").sortWithinPartitions("bucket", *KEY)
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        generations.clear(spark, keys, batch_id, fan)
        runs = generations.live(batch_id, fan)
        # Read twice, for its buckets and for its rows.
        fresh = batch.dropDuplicates(KEY).select("*", bucket).persist()
        try:
            left = fresh
            if runs:
                touched = [row["bucket"] for row in fresh.select("bucket").distinct().collect()]
                old = stored_keys(batch.sparkSession, keys, runs, kinds, touched).alias("old")
                same = [F.col(f"new.{name}").eqNullSafe(F.col(f"old.{name}")) for name in KEY]
                left = fresh.alias("new").join(old, [F.col("new.bucket") == F.col("old.bucket"), *same], "left_anti")
            left.drop("bucket").write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        finally:
            fresh.unpersist()
        # The index holds what the table holds.
        written = spark.read.schema(kinds).parquet(f"{target}/batch={batch_id}").select(*KEY, bucket)
        generations.add(written, keys, batch_id, f"{kinds}, bucket int", store, lambda index: index, fan)

    return write


def stored_keys(spark: SparkSession, keys: str, runs: list[tuple[int, int]], kinds: str, touched: list[int]) -> DataFrame:
    """The keys of the runs in the buckets ``touched``; folders of other buckets are not read."""
    return generations.read(spark, keys, runs, f"{kinds}, bucket int").filter(F.col("bucket").isin(touched))


def append_new(records: DataFrame, target: str, keys: str, checkpoint: str, *, buckets: int = 64, fan: int = generations.FAN, interval_seconds: int | None = None) -> StreamingQuery:
    """Append the first arrival of each (channel, message), however late a copy arrives.

    The keys written so far are a table of their own, by bucket of the channel, in
    runs that are sorted and merged as they get more (see ``generations``). A batch
    drops repeats within itself and rows whose key is stored; of the runs it reads
    the buckets that it touches. Run again after a failure, it replaces what it
    wrote. There is no bound in time and no state but the tables.
    """
    write = first_arrivals(records.sparkSession, records.schema, target, keys, buckets=buckets, fan=fan)
    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**_trigger(interval_seconds)).start()


def _trigger(interval_seconds: int | None) -> dict:
    return {"processingTime": f"{interval_seconds} seconds"} if interval_seconds else {"availableNow": True}


def append(records: DataFrame, target: str, checkpoint: str, *, interval_seconds: int | None = None) -> StreamingQuery:
    """Append to the table at ``target``, every ``interval_seconds`` or once over all there is.

    The checkpoint and the sink's own log make a restart go on where the last
    run stopped, with every row written exactly once.
    """
    return (
        records.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval_seconds))
        .start()
    )


def collect_until(start: Callable[[int | None], StreamingQuery], stop: Callable[[StreamingQuery], bool], *, interval_seconds: int = SAVE_INTERVAL_SECONDS, poll_seconds: float = 0.2) -> None:
    """Flush every ``interval_seconds`` until ``stop`` says so, then once more all that has arrived by then.

    ``start`` starts a query that goes on from its checkpoint, given the seconds
    between flushes, or None for a last drain; ``append``, ``append_new`` and
    ``append_trace`` do. A flush that the stop cuts short is done again by the
    drain, so every row is written exactly once. A failed query raises its error;
    the next call goes on behind its last whole flush.
    """
    query = start(interval_seconds)
    try:
        while not stop(query):
            if query.awaitTermination(poll_seconds):
                break
    finally:
        query.stop()
    start(None).awaitTermination()


TRACE = "channel_username string, messages_written long"


def _added_up(counts: DataFrame) -> DataFrame:
    return counts.groupBy("channel_username").agg(F.sum("messages_written").alias("messages_written"))


def trace_batches(spark: SparkSession, target: str, *, fan: int = generations.FAN) -> Callable[[DataFrame, int], None]:
    """What ``append_trace`` does with each batch."""

    def store(counts: DataFrame, path: str) -> None:
        counts.hint("rebalance").write.mode("overwrite").parquet(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        generations.clear(spark, target, batch_id, fan)
        counts = batch.select("channel_username", F.lit(1).cast("long").alias("messages_written"))
        generations.add(counts, target, batch_id, TRACE, store, _added_up, fan)

    return write


def append_trace(records: DataFrame, target: str, checkpoint: str, *, fan: int = generations.FAN, interval_seconds: int | None = None) -> StreamingQuery:
    """Keep per-channel counts: each batch writes its own under its number, and runs of them are added up as they get more.

    A batch that is run again after a failure replaces what it wrote before, sums it completed included.
    """
    write = trace_batches(records.sparkSession, target, fan=fan)
    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**_trigger(interval_seconds)).start()


def read_trace(spark: SparkSession, target: str, *, fan: int = generations.FAN) -> DataFrame:
    """Messages written per channel over all batches so far, from a bounded number of runs."""
    return _added_up(generations.read(spark, target, generations.current(spark, target, fan), TRACE))
