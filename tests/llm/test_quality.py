"""The classifier on held-out rows of the given tables, its parts, and awkward rows."""

import zlib

import numpy as np
import pyarrow as pa
from llm.fixtures import docs

from tablepull.llm import quality
from tablepull.llm.queries import QUALITY_BAR, op7_quality_classifier

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in op7_quality_classifier(spark, SF_DIR).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= QUALITY_BAR) for r in got.values())
    held = [(labels[i], r["predicted"]) for i, r in got.items() if r["held_out"] and i in labels]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert sum(b for a, b in held if a == 1) >= 0.97 * sum(a == 1 for a, _ in held)


def test_dual_coordinate_descent_reaches_the_optimum():
    draw = np.random.default_rng(0)
    rows = [np.unique(draw.integers(0, 30, 8)) for _ in range(60)]
    signs, ratio = np.where([0 in r or 1 in r for r in rows], 1.0, -1.0), draw.normal(size=quality.DIMENSIONS)
    x = np.zeros((60, 31))
    for i, r in enumerate(rows):
        x[i, r] = quality._unit(r, ratio)
        x[i, 30] = 1
    loss = lambda w: (w @ w) / 2 + quality.COST * np.maximum(0, 1 - signs * (x @ w)).sum()
    weight, bias = quality._descend(rows, signs, ratio)
    found = loss(np.append(weight[:30], bias))
    assert all(found <= loss(np.append(weight[:30], bias) + 0.05 * draw.normal(size=31)) + 0.05 for _ in range(200))


def test_grams_and_repetitions():
    texts = ["", None, "a", "ab", "abab", "x y z w " * 50, "b b b b b b"]
    ids = list(quality.gram_ids(pa.array(texts)))
    assert [len(i) for i in ids[:5]] == [0, 0, 1, 3, 2 + 2 + 2]
    assert all(len(np.unique(i)) == len(i) and (i < quality.DIMENSIONS).all() for i in ids)
    repeats = [int((i >= quality._REPEATS).sum()) for i in ids]
    assert repeats[5] == 7 and repeats[6] == 14


def test_awkward_rows(spark):
    texts = ["good words here and there"] * 6 + ["%%% ### $$$ %%%"] * 6 + [None, "", (None, "x"), (None, "x"), "word " * 40_000]
    frame = docs(spark, texts, extra=True)
    marks = [(i, int(i < 6)) for i in range(12)] + [(0, 0), (1, None), (None, 1), (2, 1), (99, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    model = quality.train_quality(frame, labels)
    scored = quality.score_quality(frame, model)
    rows = scored.collect()
    assert scored.columns == ["doc_id", "score"] and len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r["score"] for r in rows}
    assert by[5] > by[6] and by[12] == by[13]
    kept = quality.keep_quality(frame, model, 0.0)
    assert kept.columns == frame.columns and kept.count() == len(texts)
    flat = quality.train_quality(frame, labels.where("quality = 1"))
    assert len({round(r["score"], 12) for r in quality.score_quality(frame, flat).collect()}) == 1
    nothing = quality.train_quality(frame.limit(0), labels.limit(0))
    assert quality.score_quality(frame.limit(0), nothing).count() == 0
    assert not frame.select(quality.held_out(frame.doc_id).alias("h")).where("h is null").count()
