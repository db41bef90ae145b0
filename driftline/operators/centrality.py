"""Centralities of an undirected weighted word graph.

``nodes`` has one column ``token``; ``edges`` has ``a, b, weight`` in both
directions, no loops, positive whole weights.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.operators.joins import lookup_join
from driftline.operators.ranking import global_rank
from driftline.session import shuffle_width, stage

# Sent along with the tasks, so workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Graphs of so many edges, both ways counted, come to the driver once, eight bytes each, 320 MB at most; those that can be on a shortest path are sent to all tasks.
MAX_EDGES = 40_000_000
# Edges with which bounds of the distances are taken, the lightest of each node, and nodes over which these run.
LIGHT, HUBS = 64, 64
# Rows of a step for a slice of sources in larger ones.
WORKING_ROWS = 200_000_000

COLUMNS = ["token", "degree_centrality", "betweenness_centrality", "weighted_degree"]


def node_count(nodes: DataFrame):
    return nodes.agg(F.count(F.lit(1))).scalar()


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``token, degree_centrality, weighted_degree``; degree is neighbours / (n - 1), or 1 for a single node."""
    around = edges.groupBy(F.col("a").alias("token")).agg(
        F.count(F.lit(1)).alias("neighbours"), F.sum("weight").alias("strength")
    )
    n = node_count(nodes)
    share = F.coalesce("neighbours", F.lit(0)) / (n - 1)
    return nodes.join(around, "token", "left").select(
        "token",
        F.when(n == 1, F.lit(1.0)).otherwise(share).alias("degree_centrality"),
        F.coalesce("strength", F.lit(0)).cast("double").alias("weighted_degree"),
    )


def distances(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """``s, v, d``: length of the shortest path from the ``sources`` (``token``) to all other nodes they are connected with.

    Only pairs that got shorter in a round are extended in the next one.
    """
    first = edges.join(sources.select(F.col("token").alias("a")), "a", "left_semi")
    best = stage(first.select(F.col("a").alias("s"), F.col("b").alias("v"), F.col("weight").alias("d"), F.lit(True).alias("improved")))
    steps = edges.select(F.col("a").alias("v"), F.col("b").alias("next"), "weight")
    while True:
        longer = (
            best.filter("improved")
            .join(steps, "v")
            .filter("next != s")
            .select("s", F.col("next").alias("v"), F.lit(None).cast("long").alias("d"), (F.col("d") + F.col("weight")).alias("found"))
        )
        known = best.select("s", "v", "d", F.lit(None).cast("long").alias("found"))
        improved = F.coalesce(F.col("found") < F.col("d"), F.col("d").isNull())
        best = stage(
            known.unionByName(longer)
            .groupBy("s", "v")
            .agg(F.min("d").alias("d"), F.min("found").alias("found"))
            .select("s", "v", F.least("d", "found").alias("d"), improved.alias("improved"))
        )
        if best.filter("improved").isEmpty():
            return best.select("s", "v", "d")


def shortest_path_steps(dist: DataFrame, edges: DataFrame) -> DataFrame:
    """``s, u, v``: edge u-v is the last step of a shortest path from s to v."""
    step = edges.select(F.col("a").alias("u"), F.col("b").alias("v"), "weight")
    from_source = dist.select("s", F.col("v").alias("u"), F.col("d").alias("du"))
    # Only sources have a distance, so steps from other nodes go in the join below.
    direct = step.select(F.col("u").alias("s"), "u", "v", F.col("weight").alias("d"))
    via = from_source.join(step, "u").select("s", "u", "v", (F.col("du") + F.col("weight")).alias("d"))
    return direct.unionByName(via).join(dist, ["s", "v", "d"]).select("s", "u", "v")


def _sum_of_rounds(rounds: list[DataFrame], value: str) -> DataFrame:
    total = rounds[0]
    for part in rounds[1:]:
        total = total.unionByName(part)
    return total.groupBy("s", "v").agg(F.sum(value).alias(value))


def path_counts(steps: DataFrame) -> DataFrame:
    """``s, v, paths``: number of shortest paths, summed over their number of steps."""
    inner = steps.select("s", F.col("u").alias("v"), F.col("v").alias("next"))
    current = stage(steps.filter("u = s").select("s", "v", F.lit(1.0).alias("paths")))
    rounds = []
    while not current.isEmpty():
        rounds.append(current)
        onward = current.join(inner, ["s", "v"]).groupBy("s", F.col("next").alias("v"))
        current = stage(onward.agg(F.sum("paths").alias("paths")))
    return _sum_of_rounds(rounds or [current], "paths")


def dependencies(steps: DataFrame, paths: DataFrame) -> DataFrame:
    """``s, v, share``: over all targets, the part of the shortest paths from s that runs through v.

    A target gives each predecessor its part of the paths, and so on backwards;
    the rounds end with the longest shortest path.
    """
    before = paths.select("s", F.col("v").alias("u"), F.col("paths").alias("to_u"))
    back = stage(
        steps.filter("u != s")
        .join(paths, ["s", "v"])
        .join(before, ["s", "u"])
        .select("s", "v", "u", (F.col("to_u") / F.col("paths")).alias("part"))
    )
    current = paths.select("s", "v", F.lit(1.0).alias("share"))
    rounds = []
    while True:
        onward = current.join(back, ["s", "v"]).groupBy("s", F.col("u").alias("v"))
        current = stage(onward.agg(F.sum(F.col("share") * F.col("part")).alias("share")))
        rounds.append(current)
        if current.isEmpty():
            return _sum_of_rounds(rounds, "share")


def _slice_shares(sources: DataFrame, edges: DataFrame) -> DataFrame:
    """``token, share`` summed over the ``sources``: distances and path counts forwards, parts of paths backwards."""
    dist = distances(edges, sources)
    steps = stage(shortest_path_steps(dist, edges))
    paths = stage(path_counts(steps))
    return dependencies(steps, paths).groupBy(F.col("v").alias("token")).agg(F.sum("share").alias("share"))


def shares_by_slices(nodes: DataFrame, edges: DataFrame, working_rows: int = WORKING_ROWS) -> DataFrame:
    """``token, share``: over all sources, slice by slice.

    A step of a slice makes at most a row per source and edge, so as many sources
    are taken at a time as keep that below ``working_rows``, one at least. Only a
    sum per word outlives its slice.
    """
    n, m = nodes.count(), edges.count()
    slices = min(max(1, n), -(-n * m // working_rows) or 1)
    dealt = stage(global_rank(nodes.select("token"), [F.col("token")]))
    sums = stage(nodes.select("token", F.lit(0.0).alias("share")))
    for k in range(slices):
        part = _slice_shares(dealt.filter(F.col("rank") % slices == k), edges)
        sums = stage(sums.unionByName(part).groupBy("token").agg(F.sum("share").alias("share")))
    return sums


class Arrays:
    """A graph as arrays: the edges of each node side by side, light ones first."""

    def __init__(self, n: int, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> None:
        order = np.lexsort((weight, a))
        self.n, self.ends, self.weights = n, b[order].astype(np.int32), weight[order]
        self.begins = np.concatenate([[0], np.cumsum(np.bincount(a, minlength=n))])

    def _places(self, nodes: np.ndarray, heaviest: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the edges of ``nodes`` up to a weight, and how many each node has."""
        begins, ends = self.begins[nodes], self.begins[nodes + 1]
        if heaviest < self.weights.max(initial=0):
            ends = begins + [np.searchsorted(self.weights[i:j], heaviest, side="right") for i, j in zip(begins, ends)]
        sizes = ends - begins
        return np.repeat(begins - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum()), sizes

    def distances(self, source: int) -> np.ndarray:
        """The shortest distance to each node; all nodes of one distance are settled at once."""
        far = np.iinfo(np.int64).max
        dist = np.full(self.n, far)
        dist[source] = 0
        left = np.ones(self.n, bool)
        while left.any() and (near := dist[left].min()) < far:
            front = np.flatnonzero(left & (dist == near))
            left[front] = False
            # No heavier edge can shorten a way to what is left.
            bound = dist[left].max(initial=0)
            places, _ = self._places(front, int(bound - near - 1))
            ends, found = self.ends[places], self.weights[places] + near
            better = found < dist[ends]
            np.minimum.at(dist, ends[better], found[better])
        return dist

    def shares(self, source: int) -> np.ndarray:
        """For each node the part of the shortest paths from ``source`` that runs through it, summed over all targets."""
        dist = self.distances(source)
        reached = np.flatnonzero(dist < np.iinfo(np.int64).max)
        places, sizes = self._places(reached, int(dist[reached].max()))
        begin, end = np.repeat(reached, sizes), self.ends[places]
        on = dist[begin] + self.weights[places] == dist[end]
        begin, end = begin[on], end[on]
        order = np.argsort(dist[end], kind="stable")
        begin, end = begin[order], end[order]
        levels = np.flatnonzero(np.diff(dist[end], prepend=-1))
        bounds = list(zip(levels, [*levels[1:], len(end)]))
        paths, share = np.zeros(self.n), np.zeros(self.n)
        paths[source] = 1
        for i, j in bounds:
            np.add.at(paths, end[i:j], paths[begin[i:j]])
        for i, j in reversed(bounds):
            u, v = begin[i:j], end[i:j]
            np.add.at(share, u, paths[u] / paths[v] * (1 + share[v]))
        share[source] = 0
        return share


def _lightest(key: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` lightest edges of each key."""
    order = np.lexsort((weight, key))
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
    return order[rank < n]


def both_ways(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([weight, weight])


def on_paths(n: int, a: np.ndarray, b: np.ndarray, weight: np.ndarray, *, light: int = LIGHT, hubs: int = HUBS) -> np.ndarray:
    """Places of the edges, one way each, that can be on a shortest path.

    A way over a hub along the lightest edges of each node is a bound of a
    distance; an edge heavier than that is never a step of a shortest path.
    """
    some = np.union1d(_lightest(a, weight, light), _lightest(b, weight, light))
    graph = Arrays(n, *both_ways(a[some], b[some], weight[some]))
    left = np.arange(len(a))
    for hub in np.argsort(-np.diff(graph.begins), kind="stable")[:hubs]:
        # Halved, so that two of them can be added.
        dist = np.minimum(graph.distances(int(hub)), np.iinfo(np.int64).max // 2)
        left = left[weight[left] <= dist[a[left]] + dist[b[left]]]
    return left


def shares_by_arrays(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``token, share`` of a graph that fits in a task: tasks get slices of sources, work through them one by one and send one sum per word."""
    spark = nodes.sparkSession
    ids = stage(global_rank(nodes.select("token"), [F.col("token")]).select("token", (F.col("rank") - 1).cast("int").alias("id")))
    once = edges.filter("a < b")
    named = lookup_join(once, ids.select(F.col("token").alias("a"), F.col("id").alias("from")), "a", "inner")
    named = lookup_join(named, ids.select(F.col("token").alias("b"), F.col("id").alias("to")), "b", "inner")
    # At most half of MAX_EDGES rows of three numbers, counted before.
    found = named.select("from", "to", F.col("weight").cast("bigint").alias("weight")).toArrow()
    n = ids.count()
    columns = [found.column(name).to_numpy() for name in ("from", "to", "weight")]
    kept = on_paths(n, *columns)
    sent = spark.sparkContext.broadcast(tuple(column[kept] for column in columns))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = Arrays(n, *both_ways(*sent.value))
        total = np.zeros(graph.n)
        for batch in batches:
            for source in batch.column("id").to_pylist():
                total += graph.shares(source)
        on = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(on, pa.int32()), pa.array(total[on])], ["id", "share"])

    width = max(spark.sparkContext.defaultParallelism, shuffle_width(spark))
    sources = ids.select("id").repartition(min(max(1, n), 4 * width))
    sums = sources.mapInArrow(each, "id int, share double").groupBy("id").agg(F.sum("share").alias("share"))
    return ids.join(sums, "id").select("token", "share")


def betweenness(nodes: DataFrame, edges: DataFrame, *, max_edges: int = MAX_EDGES, working_rows: int = WORKING_ROWS) -> DataFrame:
    """``token, betweenness_centrality``, exact and normalised; the edge weight is a distance.

    Sources are taken in slices, and no table of all pairs is held. A graph of up
    to ``max_edges`` edges is sent to all tasks; the slices of a larger one are
    joins of at most about ``working_rows`` rows. ``edges`` is read several times,
    so pass it staged or cheap.
    """
    edges = edges.select("a", "b", "weight")
    through = shares_by_arrays(nodes, edges) if edges.count() <= max_edges else shares_by_slices(nodes, edges, working_rows)
    n = node_count(nodes)
    value = F.coalesce("share", F.lit(0.0)) / ((n - 1) * (n - 2))
    return nodes.join(through, "token", "left").select(
        "token", F.when(n <= 2, F.lit(0.0)).otherwise(value).alias("betweenness_centrality")
    )


def word_centrality(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """All centralities per token, the strongest bridges first."""
    return (
        degrees(nodes, edges)
        .join(betweenness(nodes, edges), "token")
        .select(*COLUMNS)
        .orderBy(F.desc("betweenness_centrality"), F.desc("degree_centrality"), F.desc("weighted_degree"), "token")
    )
