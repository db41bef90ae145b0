"""Files in the folder that driver and executors share, written whole or not at all."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from driftline.session import working_path


def store(uri: str):
    """The file system of a path or address, and the path within it."""
    uri = re.sub(r"^file:/(?!/)", "file:///", uri)
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


@contextmanager
def written_once(folder: str, name: str) -> Iterator:
    """An output stream whose file gets its name when it is complete.

    A task that runs twice replaces its file by an equal one; half a file never
    has the name.
    """
    place, path = store(folder)
    place.create_dir(path, recursive=True)
    unfinished = os.path.join(path, f"_{name}.{uuid.uuid4().hex}")
    with place.open_output_stream(unfinished) as out:
        yield out
    place.move(unfinished, os.path.join(path, name))


def open_file(folder: str, name: str):
    place, path = store(folder)
    return place.open_input_file(os.path.join(path, name))


@contextmanager
def set_to(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session for the time being."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# What a table was shuffled through is of no use once the table is stored.
STORING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once as Parquet in the shared folder; its lineage and its shuffle files end there."""
    spark = df.sparkSession
    path = working_path(spark, name)
    with set_to(spark, STORING):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
