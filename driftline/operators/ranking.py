"""Top-n per key and global ranks without one large sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.operators.joins import lookup_join
from driftline.session import shuffle_width, stage


def top_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, *, salts: int = 16) -> DataFrame:
    """First ``n`` rows of each key in ``order``, with their 1-based ``rank``.

    Two rounds: each key is first cut to ``n`` rows within slices of the input,
    and only what is left meets in one group. A hot key thus sends at most
    ``n * salts`` rows to its last task. The slice a row falls in does not
    change the result.
    """
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(*order)
    in_key = Window.partitionBy(*keys).orderBy(*order)
    survivors = (
        df.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .withColumn("_place", F.row_number().over(in_slice))
        .filter(F.col("_place") <= n)
        .drop("_slice", "_place")
    )
    return survivors.withColumn("rank", F.row_number().over(in_key)).filter(F.col("rank") <= n)


def top_n_wide(df: DataFrame, keys: list[str], at: list[Column], n: int) -> DataFrame:
    """``top_n_per_key``, highest ``at`` first, for rows too wide to shuffle before they are chosen.

    Keys and order alone are ranked to find the last place of each key. The full
    rows are then filtered against it, which takes no shuffle where the table of
    last places is small, and only what is left is ranked again. NULLs come last.
    """
    names = [f"_at{i}" for i in range(len(at))]
    placed = df.withColumns(dict(zip(names, at)))
    order = [F.desc_nulls_last(name) for name in names]
    last = top_n_per_key(placed.select(*keys, *names), keys, order, n).filter(F.col("rank") == n)
    bounds = stage(last.select(*keys, F.struct(*names).alias("_last")))
    # Struct comparison puts NULL below every value, as the order above does.
    reached = F.col("_last").isNull() | (F.struct(*names) >= F.col("_last"))
    chosen = lookup_join(placed, bounds, keys).filter(reached).drop("_last")
    in_key = Window.partitionBy(*keys).orderBy(*order)
    return chosen.withColumn("rank", F.row_number().over(in_key)).filter(F.col("rank") <= n).drop(*names)


def global_rank(df: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``rank``, the 1-based position of each row in a total ``order``.

    Rows are range-partitioned and numbered inside their partition; a running
    sum over the partition sizes (one row per partition) gives the rest.
    """
    width = shuffle_width(df.sparkSession)
    placed = stage(
        df.repartitionByRange(width, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33))
        .withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_id")
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    # As many rows as shuffle partitions, whatever the size of the data.
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn("rank", F.col("_before") + F.col("_place") + 1)
        .drop("_part", "_place", "_before")
    )
