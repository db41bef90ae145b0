"""Writers of result tables. Every task writes its own files."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CSV_OPTIONS = {
    "header": True,
    "quoteAll": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def run_stamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")


def write_csv(df: DataFrame, path: str, *, run_id: str | None = None, mode: str = "overwrite") -> str:
    """Write quoted CSV with a header; with a ``run_id`` into that run's folder below ``path``."""
    target = f"{path}/run_id={run_id}" if run_id else path
    df.write.mode(mode).options(**CSV_OPTIONS).csv(target)
    return target


def write_appended(df: DataFrame, path: str, run_id: str) -> str:
    """Add rows to a table partitioned by run; earlier runs stay as they are."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").options(**CSV_OPTIONS).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def write_graph(nodes: DataFrame, edges: DataFrame, path: str, *, run_id: str | None = None) -> str:
    """A graph as two tables, ``nodes`` and ``edges``."""
    write_csv(nodes, f"{path}/nodes", run_id=run_id)
    write_csv(edges, f"{path}/edges", run_id=run_id)
    return path


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def once(spark: SparkSession, path: str, rows: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``, written from ``rows`` unless an earlier run has done so; half of one is written anew."""
    if not finished(spark, path):
        rows().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
