"""k-means rounds against a plain loop in whole numbers, and the geometry of the bounds."""

import math
import random
from hashlib import sha256

import numpy as np
import pytest

from tablepull.llm import clusters

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, rounds, dims, scale=256):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for j in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, found) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assign()
    inertia = [sum(d for d, c in found if c == j) for j in range(len(centroids))]
    digest = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia), digest[c]) for (i, _), (d, c) in zip(kept, found)), key=str)


def table(spark, rows):
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    return frame.selectExpr("*", "'x' AS id", "2 AS cluster", "'y' AS q", "0 AS distance", "1 AS `with blank.dot`")


def vectors(n, dims, seed, spread=0.3):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(5)]
    return [(i, [float(np.float32(c + rng.gauss(0, spread))) for c in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("k, rounds, spread", [(7, 5, 0.3), (40, 3, 0.05), (1, 2, 0.3), (500, 2, 0.3)])
def test_equals_a_plain_loop(spark, k, rounds, spread):
    rows = vectors(300, 6, k, spread)
    got = clusters.clustered(table(spark, rows), k=k, rounds=rounds, dims=6)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, k, rounds, 6)


def test_nulls_ties_repeats_and_odd_vectors(spark):
    rows = vectors(60, 3, 1) + [(i, [0.5, 0.5, 0.5]) for i in range(100, 140)] + [(100, [0.5, 0.5, 0.5])] * 5
    rows += [(None, [0.1, 0.2, 0.3]), (200, None), (201, []), (202, [1.0, 2.0]), (203, [1.0, None, 2.0]), (204, [float("nan"), 0.0, 0.0]), (205, [0.0, float("inf"), 0.0]), (206, [0.0, 0.0, 0.0])]
    got = clusters.clustered(table(spark, rows), k=20, rounds=4, dims=3)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 20, 4, 3)


def test_empty_and_too_large(spark):
    assert clusters.clustered(table(spark, [])).count() == 0
    assert clusters.clustered(table(spark, [(1, None), (2, [1.0])])).count() == 0
    with pytest.raises(ValueError, match="too large"):
        clusters.clustered(table(spark, [(1, [1e30, 0.0])]), dims=2)
    # Beyond what double precision holds exactly, whole numbers of 64 bits are used.
    rows = [(i, [i * 40_000.0, 1.0, float(np.float32(1 / 3 + i))]) for i in range(30)]
    assert sorted(map(tuple, clusters.clustered(table(spark, rows), k=4, dims=3).collect()), key=str) == brute(rows, 4, 5, 3)


def test_bounds_spare_most_scans(spark):
    """Vectors in well parted groups are scanned once, by the first assignment; later rounds leave nearly all alone."""
    rows = vectors(400, 8, 3, 0.02)
    found = clusters.cluster_vectors(table(spark, rows), k=5, dims=8, rounds=5)
    assert found.vectors.where("scanned").count() < 0.1 * len(rows)
    assert sum(found.sizes) == len(rows)


def test_loosening_holds_and_is_below_the_full_move():
    rng = np.random.default_rng(0)
    for _ in range(200):
        k, dims = 6, int(rng.integers(1, 9))
        old = rng.integers(-300, 300, (k, dims))
        new = old + rng.integers(-60, 60, (k, dims)) * rng.integers(0, 2, (k, 1))
        radius = rng.uniform(0, 250, k)
        loose = clusters.loosening(old, new, radius)
        full = np.sqrt(np.square(new - old).sum(axis=1))
        for i in range(k):
            others = np.arange(k) != i
            assert loose[i] <= full[others].max() * (1 + 1e-6) + 1e-6
            direction = rng.normal(size=(200, dims))
            points = old[i] + direction / np.linalg.norm(direction, axis=1)[:, None] * radius[i] * rng.uniform(0, 1, (200, 1))
            shrunk = np.linalg.norm(points[:, None] - old, axis=2) - np.linalg.norm(points[:, None] - new, axis=2)
            assert (shrunk[:, others] <= loose[i]).all()
    # A sphere far off and at right angles to a move: far less than the move.
    old, new = np.array([[0, 1000], [0, 0]]), np.array([[0, 1000], [100, 0]])
    assert clusters.loosening(old, new, np.array([10.0, 0.0]))[0] < 10
