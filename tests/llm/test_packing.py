"""Best-fit packing: the bins hold what they may, and the search is a best fit."""

import random
from collections import defaultdict

from llm.fixtures import DOC_SCHEMA, docs
from pyspark.sql import functions as F

from tablepull.llm import packing
from tablepull.llm.queries import QUERIES


def plain(lengths, sources, clusters, capacity):
    """Best fit by looking at all bins for every piece."""
    pieces = sorted(((min(capacity, n - s), r, k, s) for r, n in enumerate(lengths) for k, s in enumerate(range(0, n, capacity))), key=lambda p: (-p[0], p[1], p[2]))
    bins, out = [], []
    repeated = lambda values, r: values[r] is not None and values.count(values[r]) > 1
    for n, r, k, s in pieces:
        fit = [
            (room, b) for b, (room, rows) in enumerate(bins)
            if room >= n and room and not any((repeated(sources, r) and sources[o] == sources[r]) or (repeated(clusters, r) and clusters[o] == clusters[r]) for o in rows)
        ]
        if fit:
            room, b = min(fit)
        else:
            room, b = capacity, len(bins)
            bins.append([capacity, []])
        bins[b][0] -= n
        bins[b][1].append(r)
        out.append((r, k, s, n, b, capacity - room))
    return out


def test_best_fit_with_conflicts():
    draw = random.Random(3)
    for _ in range(30):
        n = draw.randint(1, 60)
        lengths = [draw.choice([0, 1, 5, 17, 40, 64, 65, 200]) for _ in range(n)]
        sources = [draw.choice(["a", "b", "c", None, str(i)]) for i in range(n)]
        clusters = [draw.choice([1, 2, 100 + i]) for i in range(n)]
        assert packing.pack(lengths, sources, clusters, 64) == plain(lengths, sources, clusters, 64)


def test_bins_hold_what_they_may(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 40)
    draw = random.Random(6)
    rows = [(i, " ".join(["w"] * draw.randint(0, 150)), "en", f"s{draw.randint(0, 3) if i % 3 else 0}", 0) for i in range(200)]
    frame = spark.createDataFrame(rows, DOC_SCHEMA)
    source, size = {r[0]: r[3] for r in rows}, {r[0]: len(r[1].split()) for r in rows}
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in packing.pack_documents(frame, capacity=100).collect():
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["n_tokens"]))
        if r["bin_id"] is not None:
            bins[r["bin_id"]].append((r["bin_offset"], r["n_tokens"], r["doc_id"]))
    for i, parts in pieces.items():
        parts.sort()
        assert sum(p[2] for p in parts) == size[i] and [p[1] for p in parts] == [100 * k for k in range(len(parts))]
    assert set(pieces) == set(range(200))
    for held in bins.values():
        held.sort()
        assert [h[0] for h in held] == [sum(x[1] for x in held[:k]) for k in range(len(held))] and sum(h[1] for h in held) <= 100
        assert len({source[h[2]] for h in held}) == len(held)
    # Texts of equal words are one cluster: no bin holds two.
    assert all(len({size[h[2]] for h in held}) == len(held) for held in bins.values())


def test_awkward_rows(spark):
    frame = docs(spark, [None, "", " \n", "a b", "A  b", (None, "x y"), (None, "x y"), "w " * 5000], extra=True).withColumn("source", F.lit(None).cast("string"))
    rows = packing.pack_documents(frame).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert [(by[i][0]["n_tokens"], by[i][0]["bin_id"]) for i in range(3)] == [(0, None)] * 3
    assert by[3][0]["bin_id"] != by[4][0]["bin_id"] and len({r["bin_id"] for r in by[None]}) == 2
    assert sorted(r["n_tokens"] for r in by[7]) == [5000 - 2 * 2048, 2048, 2048]
    assert packing.pack_documents(frame.limit(0)).count() == 0
    big = spark.createDataFrame([(2**60 + 1, "a", "en", "s", 1), (None, "b", "en", "s", 1)], DOC_SCHEMA)
    assert {r["doc_id"] for r in packing.pack_documents(big).collect()} == {2**60 + 1, None}


def test_near_copies_share_no_bin(spark, tmp_path):
    """Op 6 on near copies from different sources, one of them without an id."""
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[:at] + ["other"] + base[at + 1 :]).title() for at in (0, 1, 58, 59)] + ["x y z", "X  y z"]
    rows = [(i if i else None, t, "en", f"s{i}", 0) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOC_SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    bins = {r["doc_id"]: r["bin_id"] for r in QUERIES["op6_best_fit_packing"](spark, str(tmp_path)).collect()}
    assert set(bins) == {None, 1, 2, 3, 4, 5}
    assert len({bins[i] for i in (None, 1, 2, 3)}) == 4 and bins[4] != bins[5]
