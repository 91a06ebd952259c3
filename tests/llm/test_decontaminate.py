"""Benchmark items in documents against sliding over all windows."""

import random
from collections import Counter

from llm.fixtures import docs, text

from tablepull.llm import decontaminate


def grams(words, size):
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows, items, bar=0.75):
    out = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        for i, s in items:
            v = (s or "").encode().lower().split()
            size, n = min(5, len(v)), min(len(v), len(w))
            if not v or n < size:
                continue
            want, best = grams(v, size), [0.0, 0, 0]
            for start in range(len(w) - n + 1):
                have = grams(w[start : start + n], size)
                same = sum((have & want).values()) / sum((have | want).values())
                if same >= bar:
                    best[2] += 1
                    if same > best[0]:
                        best[:2] = same, start
            if best[2]:
                out[(d, i)] = (round(best[0], 9), best[1], len(v), best[2])
    return out


def run(frame, bench):
    return {(r["doc_id"], r["item_id"]): (round(r["similarity"], 9), r["start_word"], r["n_words"], r["n_windows"]) for r in decontaminate.contaminated(frame, bench).collect()}


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_planted_items_equal_brute_force(spark, monkeypatch):
    draw = random.Random(8)
    bench = [text(n, 50 + n) for n in (5, 9, 20, 20, 45)] + ["a b c", "a b a b a b a b a b", text(20, 70) + " tail", "solo"]
    texts = []
    for k in range(60):
        w = text(draw.choice([0, 3, 40]), 200 + k).split()
        for _ in range(draw.choice([0, 1, 2])):
            item = draw.choice(bench).split()
            if draw.random() < 0.4:
                item[draw.randrange(len(item))] = "changed"
            if draw.random() < 0.2:
                item = item[: len(item) * 9 // 10]
            at = draw.randint(0, len(w))
            w[at:at] = [x.upper() for x in item] if draw.random() < 0.3 else item
        texts.append(draw.choice([" ", "\n", "  "]).join(w))
    frame, bench_frame = docs(spark, texts, extra=True), items(spark, bench)
    want = brute(list(enumerate(texts)), list(enumerate(bench)))
    assert len(want) > 15 and run(frame, bench_frame) == want
    # A benchmark in several chunks gives the same.
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 300)
    assert run(frame, bench_frame) == want
    kept = decontaminate.drop_contaminated(frame, bench_frame)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == set(range(60)) - {d for d, _ in want}


def test_awkward_rows(spark):
    long = text(60_000, 1)
    bench = ["", None, " \n", "p q r s t u v", "p q r s t u v"]
    frame = docs(spark, [None, "", long + " p q r s t u v", "p q r s t u", (None, "P Q R S T U V"), (None, "P Q R S T U V")])
    rows = decontaminate.contaminated(frame, items(spark, bench)).collect()
    assert sorted((str(r["doc_id"]), r["item_id"], r["start_word"]) for r in rows) == sorted(
        [("2", i, 60_000) for i in (3, 4)] + [("None", i, 0) for i in (3, 4)] * 2
    )
    assert decontaminate.contaminated(frame.limit(0), items(spark, bench)).count() == 0
    assert decontaminate.contaminated(frame, items(spark, bench).limit(0)).count() == 0
    assert decontaminate.drop_contaminated(frame, items(spark, bench).limit(0)).count() == 6
