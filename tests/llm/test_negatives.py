"""Hard negatives against all scores, and the R-tree by itself."""

import math
import random

import numpy as np
import pytest

from tablepull.llm import negatives, rtree

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=10, positives=5, most=10, scale=256):
    kept = {}
    for i, v, label in sorted((r for r in rows if r[0] is not None and r[2] is not None and r[1]), key=lambda r: (r[0], r[2])):
        if all(x is not None and math.isfinite(x) for x in v):
            kept.setdefault(i, (label, [math.floor(scale * float(x)) for x in v]))
    out = []
    for a, (label, q) in kept.items():
        if a % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(q, v)), i, other) for i, (other, v) in kept.items() if i != a)
        for s, p, _ in [r for r in scores if r[2] == label][:positives]:
            inside = [(i, -t) for t, i, other in scores if other != label and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(a, p, rank + 1, i, -s, t) for rank, (i, t) in enumerate(inside[:most])]
    return sorted(out)


def table(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.selectExpr("*", "'x' AS id", "2 AS tile", "'y' AS q", "0 AS score", "1 AS block", "1 AS `with blank.dot`")


def vectors(n, dims, seed, labels=4):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(6)]
    return [(i, [float(np.float32(c + rng.gauss(0, 0.4))) for c in rng.choice(centres)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("part_rows, block_rows", [(8192, 2048), (40, 16)])
def test_equals_all_scores(spark, part_rows, block_rows):
    rows = vectors(600, 5, 1)
    got = negatives.hard_negatives(table(spark, rows), every=10, part_rows=part_rows, block_rows=block_rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows)
    assert len(want) > 1000 and sorted(map(tuple, got.collect())) == want


def test_hot_vectors_ties_nulls_and_repeats(spark):
    """A third of the rows hold one vector under two labels; ids, not places, decide among equal scores."""
    rows = vectors(200, 3, 2, 2) + [(1000 + i, [0.5, 0.25, 0.5], i % 2) for i in range(100)] + [(1000, [0.5, 0.25, 0.5], 0)] * 3
    rows += [(None, [0.1, 0.2, 0.3], 1), (2000, None, 1), (2010, [0.1, 0.2, 0.3], None), (2020, [], 0), (2030, [0.1, None, 0.2], 0), (2040, [0.1, float("nan"), 0.2], 0), (2050, [float("-inf"), 0.0, 0.2], 0), (2060, [0.0, 0.0, 0.0], 0), (2070, [0.2, 0.1, 0.1], 77)]
    got = negatives.hard_negatives(table(spark, rows), every=10, part_rows=30, block_rows=8)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_shared_ids_other_lengths_and_empty_tables(spark):
    rows = vectors(100, 3, 3, 2)
    odd = rows + [(20, [0.9, 0.9, 0.9], 5), (30, [1.0], 0)]
    kept = [r for r in odd if len(r[1]) == 3]
    assert sorted(map(tuple, negatives.hard_negatives(table(spark, odd), every=10).collect())) == brute(kept)
    assert negatives.hard_negatives(table(spark, [])).count() == 0
    assert negatives.hard_negatives(table(spark, [(1, [0.5], 1), (2, [0.5], 2)])).count() == 0
    assert negatives.hard_negatives(table(spark, [(0, [0.5], 1), (1, [0.5], 1), (3, [0.4], 2)])).collect() == [(0, 1, 1, 3, 128 * 128, 128 * 102)]
    with pytest.raises(ValueError, match="too large"):
        negatives.hard_negatives(table(spark, [(0, [1e20], 1)]))


def test_whole_numbers_beyond_double_precision(spark):
    rng = random.Random(4)
    rows = [(i, [float(np.float32(rng.uniform(-9e4, 9e4))) for _ in range(4)], i % 2) for i in range(80)]
    assert sorted(map(tuple, negatives.hard_negatives(table(spark, rows), every=10).collect())) == brute(rows)


def test_tree_prunes_and_keeps_ties():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(-50, 50, (2000, 2)) + c for c in ([900, 0], [0, 900], [-900, 0], [0, -900])])
    ids, labels = rng.permutation(len(points)).astype(np.int64), rng.integers(0, 3, len(points))
    tree = rtree.Tree(points, ids, labels, np.float64, leaf=32)
    query = np.array([3.0, 1.0])
    upper, lower = rtree.bounds(query[None], tree.low, tree.high)
    scores = points @ query.astype(int)
    for low, high, same in ((-(2**60), 2**60, True), (-200, 300, False), (2800, 2810, False)):
        window = rtree.Window(low, high, 10, -(2**60), same, [])
        compared = tree.search(query, 1, -1, upper[0], lower[0], [window])
        fits = ((labels == 1) == same) & (scores >= low) & (scores <= high)
        assert window.found == sorted(zip(scores[fits].tolist(), ids[fits].tolist()), key=lambda p: (-p[0], p[1]))[:10]
        assert compared < 0.3 * len(points)
