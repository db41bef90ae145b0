"""Session settings and the shared folder for checkpoints and working tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "driftline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and skew handling on.

    Extra settings go in ``conf`` with dots written as double underscores,
    e.g. ``spark__sql__shuffle__partitions="8"``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Streaming state outside the heap, for as many keys as the delay holds.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of this session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may go
    without: one machine is the whole cluster there, so a temporary folder does.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="driftline-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def working_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# What a table was shuffled through is of no use once the table is stored.
STORING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def letting_go(spark: SparkSession) -> Iterator[None]:
    """The files a table made here was shuffled through go as soon as its action ends."""
    before = spark.conf.get(STORING, None)
    spark.conf.set(STORING, "true")
    try:
        yield
    finally:
        spark.conf.unset(STORING) if before is None else spark.conf.set(STORING, before)


def stage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage, and the shuffles it came through, at the shared folder."""
    shared_dir(df.sparkSession)
    with letting_go(df.sparkSession):
        # A table of its own: the setting is read when it is made, and the plan of ``df`` keeps its shuffles.
        return df.select("*").checkpoint(eager=True)


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` computed once as Parquet in the shared folder, in folders by the columns ``by``; its shuffles go."""
    path = working_path(df.sparkSession, name)
    with letting_go(df.sparkSession):
        df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces(spark: SparkSession, rows: int, of_a_task: int = 1_000_000) -> int:
    """Number of tasks for so many rows, one per shuffle partition at least: a task holds no more of them in a larger table."""
    return max(shuffle_width(spark), -(-rows // of_a_task))
