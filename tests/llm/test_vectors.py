"""Whitening against a full eigendecomposition, clusters against plain rounds in whole numbers."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftline.llm import centroids, queries, whitening
from driftline.llm.spectral import leading, polar

ODD = [(90, None, "x"), (91, [1.0, None] + [0.5] * 62, "x"), (92, [float("nan")] + [0.0] * 63, "x"), (93, [float("-inf")] * 64, "x")]


def table(spark, rows):
    """Vectors beside columns whose names the operators use themselves."""
    wide = [(i, v, s, 1, None, 2.5, "d") for i, v, s in rows]
    return spark.createDataFrame(wide, "vec_id long, embedding array<float>, vector string, cluster int, dots string, distance double, deviation string")


def made(n, seed=5, dims=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.2, (7, dims))
    rows = centres[rng.integers(0, 7, n)] + rng.normal(0, 0.05, (n, dims)) * np.linspace(1, 0.2, dims)
    return [(i, [float(np.float32(x)) for x in row], "s") for i, row in enumerate(rows)]


def stored(tmp_path, spark, rows):
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("size", [1, 2, 3, 8, 40])
def test_polar_is_the_sign(size):
    rng = np.random.default_rng(size)
    axes, _ = np.linalg.qr(rng.normal(size=(size, size)))
    values = np.where(rng.random(size) < 0.5, -1, 1) * 10.0 ** rng.uniform(-9, 3, size)
    sign = polar(axes * values @ axes.T)
    assert np.abs(sign - axes * np.sign(values) @ axes.T).max() < 1e-5
    assert np.abs(sign @ sign - np.eye(size)).max() < 1e-13


SPECTRA = [
    [3.0, 2.0, 1.0],
    [5.0, 5.0, 5.0, 5.0],
    [1.0, 0.0, 0.0],
    [0.0, 0.0],
    [7.0],
    [1e6, 1.0, 1e-6, 1e-12],
    [4.0, 4.0, 1.0, 1.0, 1.0, -2.0],
    [1.0 + 1e-13, 1.0, 1.0 - 1e-13],
    list(2.0 ** -np.arange(30)),
    [100.0] * 20 + [0.001],
    [100.0] + [0.001] * 40,
]


@pytest.mark.parametrize("spectrum", SPECTRA)
@pytest.mark.parametrize("turned", [False, True])
def test_leading(spectrum, turned):
    size = len(spectrum)
    axes = np.linalg.qr(np.random.default_rng(size).normal(size=(size, size)))[0] if turned else np.eye(size)
    matrix = axes * np.array(spectrum) @ axes.T
    matrix = (matrix + matrix.T) / 2
    scale = max(1e-300, np.linalg.norm(matrix))
    for most in (None, 1, 2, 8):
        values, vectors = leading(matrix, most)
        expected = np.sort(spectrum)[::-1][: most or size]
        assert np.abs(values - expected).max() <= 1e-13 * scale
        assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * scale
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-13


def test_leading_of_nothing():
    values, vectors = leading(np.empty((0, 0)))
    assert len(values) == 0 and vectors.shape == (0, 0)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(-(2**60), 2**60), min_size=3, max_size=3), max_size=5), st.integers(0, 60))
def test_exact_squares(rows, shift):
    apart = np.array(rows, np.int64).reshape(-1, 3) >> shift
    assert whitening.squares(apart) == [sum(int(x) ** 2 for x in row) for row in apart.tolist()]


def plain_moments(rows):
    numbers = np.array([[math.floor(1024 * x) + 100000 for x in v] for _, v, _ in rows], dtype=object)
    n, sums = len(numbers), numbers.sum(axis=0)
    deviation = [sum(int(x) ** 2 for x in n * row - sums) for row in numbers]
    centred = np.array([[float(Fraction(int(x), n)) for x in n * row - sums] for row in numbers])
    return n, deviation, centred, centred.T @ centred / n


def test_whitening_is_that_of_all_eigenvectors(spark, tmp_path):
    rows = made(700)
    rows += [(700, rows[0][1], "again"), (0, rows[1][1], "id again"), (None, rows[2][1], "no id")]
    result = queries.op11_whitening(spark, stored(tmp_path, spark, rows + ODD)).collect()
    n, deviation, centred, covariance = plain_moments(rows)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    expected = centred @ axes / np.sqrt(values)
    assert len(result) == 8 * len(rows)
    assert {row.n for row in result} == {n}
    assert all(row.identity_error == result[0].identity_error < 1e-9 for row in result)
    got = {}
    for row in result:
        got.setdefault(row.vec_id, {}).setdefault(row.deviation, []).append((row.component, row.whitened))
        assert row.explained == pytest.approx(values[row.component - 1] / np.trace(covariance), rel=1e-10)
    signs = None
    for (vec_id, _, _), exact, line in zip(rows, deviation, expected):
        assert exact in got[vec_id]
        if vec_id in (700, 5):
            mine = np.array([w for _, w in sorted(got[vec_id][exact])])
            signs = np.sign(mine * line) if signs is None else signs
            assert np.abs(mine * signs - line).max() < 1e-8


def test_few_dimensions_and_no_variance(spark, tmp_path):
    rows = [(1, [0.5, 1.0, 3.0], ""), (2, [0.25, 1.0, 3.0], ""), (3, [0.5, 1.0], ""), (4, [], ""), (5, None, "")]
    result = queries.op11_whitening(spark, stored(tmp_path, spark, rows)).orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component) for r in result] == [(i, c) for i in (1, 2) for c in (1, 2, 3)]
    assert [abs(r.whitened) if r.whitened is not None else None for r in result[:3]] == [pytest.approx(1.0), None, None]
    assert result[0].explained == pytest.approx(1.0) and result[0].identity_error < 1e-9 and result[0].deviation == 256**2


@pytest.mark.parametrize("rows", [[], ODD, [(1, [], "")], [(1, [0.5, 0.25], "")]])
def test_nothing_to_whiten(spark, tmp_path, rows):
    result = queries.op11_whitening(spark, stored(tmp_path, spark, rows)).collect()
    assert len(result) == (2 if rows and rows[0][1] == [0.5, 0.25] else 0)
    assert all(row.whitened is None and row.identity_error is None and row.deviation == 0 for row in result)


def test_entries_beyond_exact_sums(spark):
    with pytest.raises(Exception, match="beyond exact sums"):
        whitening.fit(table(spark, [(1, [1e30] * 64, "")]))


def plain_clusters(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in rows if v and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest())
    means = [v for _, v in sorted(kept, key=lambda row: (digest(row[0]), row[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), number) for number, c in enumerate(means))

    for _ in range(rounds):
        members = [[] for _ in means]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        means = [[sum(column) // len(group) for column in zip(*group)] if group else c for group, c in zip(members, means)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    inertia = [sum(d for _, d, c in found if c == number) for number in range(len(means))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in means]
    return sorted(((i, c, d, inertia[c], total, digests[c]) for i, d, c in found), key=str)


COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("n", [0, 1, 5, 16, 300])
def test_clusters_are_those_of_plain_rounds(spark, tmp_path, n):
    rows = made(n, seed=n) + ODD + [(94, [0.5] * 63, "short"), (95, [], "")]
    if n == 300:
        # Ties: many equal vectors, also under one id and without an id.
        rows += [(i, rows[3][1], "") for i in range(300, 340)] + [(7, rows[3][1], ""), (None, rows[4][1], ""), (None, rows[4][1], "")]
    result = queries.op12_centroids(spark, stored(tmp_path, spark, rows)).select(*COLUMNS).collect()
    assert sorted(map(tuple, result), key=str) == plain_clusters(rows)


def test_only_moved_components_change_the_products(spark):
    rng = np.random.default_rng(1)
    vectors, before = rng.integers(-50, 50, (40, 6)), rng.integers(-50, 50, (3, 6))
    after = before.copy()
    after[1, [0, 4]] += [3, -2]
    numbers = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], centroids.STATE.split(", square")[0])
    state = centroids.updated_dots(centroids.first_dots(numbers, before), after - before)
    got = {row.vec_id: row.dots for row in state.collect()}
    assert [got[i] for i in range(40)] == (vectors @ after.T).tolist()


def test_equal_rows_stay_rows(spark):
    rows = [(1, [0.5] * 2, "")] * 3 + [(2, [0.5] * 2, "")]
    placed, found = centroids.cluster(table(spark, rows), k=3, rounds=2, dims=2, scale=64)
    assert [tuple(row) for row in placed.collect()].count((1, 0, 0)) == 3
    assert [row.cluster_size for row in found.orderBy("cluster").collect()] == [4, 0, 0]
