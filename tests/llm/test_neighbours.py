"""Nearest neighbours against brute force."""

import numpy as np

from tablepull.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, top):
    out = {}
    for q, v in rows.items():
        if q % every == 0:
            order = sorted((float(np.sqrt(np.square(np.array(v) - np.array(w)).sum())), i) for i, w in rows.items() if i != q)
            out[q] = [(i, d) for d, i in order[:top]]
    return out


def run(frame, **args):
    out = {}
    for r in neighbours.nearest(frame, **args).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    return out


def vectors(n, dims=16, seed=0):
    return np.random.default_rng(seed).normal(size=(n, dims)).astype(np.float32)


def test_small_table_is_exact(spark):
    x = vectors(300).tolist()
    x[7] = x[40] = x[100]
    got, want = run(spark.createDataFrame([(i, v, 0) for i, v in enumerate(x)], SCHEMA)), brute(dict(enumerate(x)), 100, 10)
    assert set(got) == set(want)
    for q in want:
        assert [g[0] for g in got[q]] == [w[0] for w in want[q]] and [g[2] for g in got[q]] == list(range(1, 11))
        assert np.allclose([g[1] for g in got[q]], [w[1] for w in want[q]], rtol=0, atol=1e-12)


def test_recall_with_few_leaves_and_split_leaves(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "MEMBERS", 20)
    x = vectors(3000, 12).tolist()
    got, want = run(spark.createDataFrame([(i, v, 0) for i, v in enumerate(x)], SCHEMA), search=3000), brute(dict(enumerate(x)), 100, 10)
    hits = sum(len({g[0] for g in got[q]} & {w[0] for w in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)


def test_a_third_of_the_rows_are_one_vector(spark):
    x = vectors(120).tolist() + [[1.0] * 16] * 60
    got, want = run(spark.createDataFrame([(i, v, 0) for i, v in enumerate(x)], SCHEMA), every=50), brute(dict(enumerate(x)), 50, 10)
    assert {q: [g[0] for g in rows] for q, rows in got.items()} == {q: [w[0] for w in rows] for q, rows in want.items()}


def test_awkward_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (100, [0.0, 1.0], 1), (5, [1.0, 1.0], 1), (5, [1.0, 1.0], 1), (6, [0.0, 0.0], 1), (7, None, 1),
        (8, [1.0, None], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [1.0, 2.0, 3.0], 1), (None, [1.0, 0.5], 1), (200, [0.0, 0.0], 1),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS v", "3 AS tree", "4 AS part")
    got = run(frame)
    assert {q: [g[0] for g in r] for q, r in got.items()} == {0: [5, 100], 100: [5, 0]}
    assert run(frame.limit(0)) == {}
    assert run(frame.where("vec_id = 7")) == {}
    assert run(frame.where("vec_id = 100")) == {}
