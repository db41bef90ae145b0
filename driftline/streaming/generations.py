"""Tables that grow by a run per batch, merged as they grow.

A run is a folder ``level=k/run=j`` that covers ``fan ** k`` batches from number
``j * fan ** k`` on. Every batch writes a run of level 0; as soon as ``fan`` runs of
a level are there, they become one of the next level. A table of n batches is thus
read from fewer than ``fan`` runs per level, and a row is written anew once per
level, about ``log(n, fan)`` times.

Which runs a batch reads and writes follows from its number alone: run again after
a failure, it replaces what it wrote and does not see its own rows. Merged runs go
when the next batch begins, which only happens once this one is done.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FAN = 8


def place(folder: str, level: int, number: int) -> str:
    return f"{folder}/level={level}/run={number}"


def live(batches: int, fan: int = FAN) -> list[tuple[int, int]]:
    """Level and number of the runs that hold the first ``batches`` batches, the oldest first."""
    runs, begin, level = [], 0, 0
    while fan ** (level + 1) <= batches:
        level += 1
    for k in range(level, -1, -1):
        while begin + fan**k <= batches:
            runs.append((k, begin // fan**k))
            begin += fan**k
    return runs


def read(spark: SparkSession, folder: str, runs: list[tuple[int, int]], schema: str) -> DataFrame:
    """The rows of the runs, which must be there. Columns that are folders below a run are part of ``schema``."""
    if not runs:
        return spark.createDataFrame([], schema)
    table = spark.read.schema(schema).option("basePath", folder).parquet(*[place(folder, *run) for run in runs])
    return table.drop("level", "run")


def add(rows: DataFrame, folder: str, batch: int, schema: str, store: Callable[[DataFrame, str], None], merge: Callable[[DataFrame], DataFrame], fan: int = FAN) -> None:
    """Write the run of a batch, and the merged ones that it completes."""
    store(merge(rows), place(folder, 0, batch))
    level = 1
    while (batch + 1) % fan**level == 0:
        number = (batch + 1) // fan**level - 1
        parts = [(level - 1, number * fan + i) for i in range(fan)]
        store(merge(read(rows.sparkSession, folder, parts, schema)), place(folder, level, number))
        level += 1


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def whole_runs(spark: SparkSession, folder: str) -> list[tuple[int, int]]:
    """All runs that were written to their end, merged ones included. A listing of folders; no file is opened."""
    marks = _files(spark, folder).globStatus(spark._jvm.org.apache.hadoop.fs.Path(place(folder, "*", "*") + "/_SUCCESS"))
    found = (re.search(r"level=(\d+)/run=(\d+)/_SUCCESS$", mark.getPath().toString()) for mark in marks or [])
    return sorted((int(match[1]), int(match[2])) for match in found)


def _within(run: tuple[int, int], other: tuple[int, int], fan: int) -> bool:
    return other[0] > run[0] and run[1] // fan ** (other[0] - run[0]) == other[1]


def current(spark: SparkSession, folder: str, fan: int = FAN) -> list[tuple[int, int]]:
    """The runs a reader takes: all whole ones but those that are part of another."""
    runs = whole_runs(spark, folder)
    return [run for run in runs if not any(_within(run, other, fan) for other in runs)]


def clear(spark: SparkSession, folder: str, batch: int, fan: int = FAN) -> None:
    """Remove the runs that were merged into others before ``batch`` began."""
    needed = set(live(batch, fan))
    for level, number in whole_runs(spark, folder):
        if (number + 1) * fan**level <= batch and (level, number) not in needed:
            _files(spark, folder).delete(spark._jvm.org.apache.hadoop.fs.Path(place(folder, level, number)), True)
