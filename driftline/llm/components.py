"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.files import kept


def _to_least(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours linked to its least neighbour or itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _to_root(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours linked to the least of them; ``b < a`` in the links."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).filter("a != b")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of all nodes of the links ``a, b``, named by the least node.

    Links are moved towards the least node of each neighbourhood until nothing
    changes, which takes a number of rounds about the logarithm of the longest
    path. Minima are summed up before the shuffle; rows of a node with very many
    links may be split by adaptive execution. Each round is a table in the shared
    folder; only its fingerprint comes to the driver.
    """
    current = kept(
        links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )

    def mark(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    before = mark(current)
    while before[0]:
        current = kept(_to_root(_to_least(current).distinct()).distinct(), "links")
        after = mark(current)
        if after == before:
            break
        before = after
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
