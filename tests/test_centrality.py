import heapq
import math
import random

import numpy as np
import pytest

from driftline.operators import centrality


def brandes(nodes, edges):
    """Betweenness by single-source shortest paths, for comparison only."""
    around = {v: [] for v in nodes}
    for a, b, w in edges:
        around[a].append((b, w))
    score = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        dist, paths, before, order = {s: 0}, {s: 1.0}, {s: []}, []
        heap, done = [(0, s)], set()
        while heap:
            d, v = heapq.heappop(heap)
            if v in done:
                continue
            done.add(v)
            order.append(v)
            for u, w in around[v]:
                if u not in dist or d + w < dist[u]:
                    dist[u], paths[u], before[u] = d + w, paths[v], [v]
                    heapq.heappush(heap, (d + w, u))
                elif d + w == dist[u] and u not in done:
                    paths[u] += paths[v]
                    before[u].append(v)
        share = dict.fromkeys(order, 0.0)
        for v in reversed(order):
            for u in before[v]:
                share[u] += paths[u] / paths[v] * (1 + share[v])
            if v != s:
                score[v] += share[v]
    n = len(nodes)
    return {v: score[v] / ((n - 1) * (n - 2)) if n > 2 else 0.0 for v in nodes}


def frames(spark, nodes, pairs):
    both = [(a, b, w) for a, b, w in pairs] + [(b, a, w) for a, b, w in pairs]
    return (
        spark.createDataFrame([(v,) for v in nodes], "token string"),
        spark.createDataFrame(both, "a string, b string, weight long"),
        both,
    )


def check(spark, nodes, pairs):
    vertices, edges, both = frames(spark, nodes, pairs)
    found = {r.token: r for r in centrality.word_centrality(vertices, edges).collect()}
    expected = brandes(nodes, both)
    assert set(found) == set(nodes)
    for v in nodes:
        assert math.isclose(found[v].betweenness_centrality, expected[v], abs_tol=1e-9)
        assert 0 <= found[v].betweenness_centrality <= 1
        assert found[v].weighted_degree == sum(w for a, _, w in both if a == v)
        assert math.isclose(found[v].degree_centrality, sum(a == v for a, _, _ in both) / (len(nodes) - 1))


def test_random_graph_with_ties_and_an_isolated_node(spark):
    rng = random.Random(7)
    nodes = [f"n{i}" for i in range(14)]
    pairs = [(a, b, rng.randint(1, 3)) for i, a in enumerate(nodes[:-1]) for b in nodes[i + 1 : -1] if rng.random() < 0.3]
    check(spark, nodes, pairs)


def test_long_path(spark):
    nodes = [f"n{i}" for i in range(7)]
    check(spark, nodes, [(a, b, 2) for a, b in zip(nodes, nodes[1:])])


def test_two_parts(spark):
    check(spark, ["a", "b", "c", "x", "y", "z"], [("a", "b", 1), ("b", "c", 1), ("x", "y", 5), ("y", "z", 5), ("x", "z", 10)])


def test_small_graphs(spark):
    vertices, edges, _ = frames(spark, ["a"], [("a", "b", 1)])
    none = edges.limit(0)
    assert [tuple(r) for r in centrality.word_centrality(vertices, none).collect()] == [("a", 1.0, 0.0, 0.0)]
    empty = centrality.word_centrality(vertices.limit(0), none)
    assert empty.count() == 0 and empty.columns == centrality.COLUMNS


def test_order(spark):
    vertices, edges, _ = frames(spark, ["a", "b", "c", "d"], [("b", "a", 1), ("b", "c", 2), ("b", "d", 2)])
    assert [r.token for r in centrality.word_centrality(vertices, edges).collect()] == ["b", "c", "d", "a"]


def random_graph(rng, n, weights, share):
    nodes = [f"n{i}" for i in range(n)]
    return nodes, [(a, b, rng.choice(weights)) for i, a in enumerate(nodes) for b in nodes[i + 1 :] if rng.random() < share]


def test_shares_of_arrays():
    rng = random.Random(11)
    for n, weights, share in [(1, [1], 0), (2, [5], 1), (30, [1], 0.2), (30, [1, 2, 3], 0.5), (25, [1, 7, 400, 10**9], 0.2), (40, [1, 1, 2, 50], 0.05)]:
        nodes, pairs = random_graph(rng, n, weights, share)
        both = pairs + [(b, a, w) for a, b, w in pairs]
        ids = {v: i for i, v in enumerate(nodes)}
        columns = [np.array([ids[a] for a, _, _ in both], int), np.array([ids[b] for _, b, _ in both], int), np.array([w for _, _, w in both], int)]
        graph = centrality.Arrays(n, *columns)
        found = sum((graph.shares(source) for source in range(n)), np.zeros(n))
        expected = brandes(nodes, both)
        for v in nodes:
            assert math.isclose(found[ids[v]] / max(1, (n - 1) * (n - 2)), expected[v], abs_tol=1e-9)


@pytest.mark.parametrize("working_rows", [1, 300, 10**9])
def test_slices_of_sources_add_up(spark, working_rows):
    """One source at a time, a few, and all."""
    rng = random.Random(5)
    nodes, pairs = random_graph(rng, 7, [1, 2, 3], 0.5)
    vertices, edges, both = frames(spark, [*nodes, "alone"], pairs)
    found = {r.token: r.betweenness_centrality for r in centrality.betweenness(vertices, edges, max_edges=0, working_rows=working_rows).collect()}
    expected = brandes([*nodes, "alone"], both)
    assert set(found) == set(expected) and all(math.isclose(found[v], expected[v], abs_tol=1e-9) for v in expected)


def test_only_edges_that_can_be_on_a_path_are_sent():
    """All edges were, and each task looked through them for every source."""
    rng = random.Random(3)
    nodes, pairs = random_graph(rng, 60, [1, 2, 3, 50, 400, 900], 0.9)
    ids = {v: i for i, v in enumerate(nodes)}
    a, b, w = (np.array(x) for x in zip(*((ids[a], ids[b], w) for a, b, w in pairs)))
    kept = centrality.on_paths(len(nodes), a, b, w, light=4, hubs=8)
    assert len(kept) < 0.7 * len(a)
    whole, part = (centrality.Arrays(len(nodes), *centrality.both_ways(a[k], b[k], w[k])) for k in (slice(None), kept))
    for source in range(len(nodes)):
        assert (whole.distances(source) == part.distances(source)).all()
        assert np.allclose(whole.shares(source), part.shares(source), atol=1e-12)
