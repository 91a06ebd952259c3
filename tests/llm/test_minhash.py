"""Near duplicates against comparing all sets."""

import random
from itertools import combinations

from llm.fixtures import docs, text, words

from tablepull.llm import minhash


def shingles(t, size=5):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def run(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(frame).collect()}


def edited(draw, source, edits):
    w = list(source)
    for _ in range(edits):
        w[draw.randrange(len(w))] = f"e{draw.randrange(10**6)}"
    return " ".join(w)


def test_families_equal_brute_force(spark):
    draw = random.Random(1)
    texts = [edited(draw, words(draw.choice([30, 80, 200]), family), draw.choice([0, 1, 1, 2, 3, 5])) for family in range(6) for _ in range(25)]
    texts += [text(200, 100 + i) for i in range(20)]
    draw.shuffle(texts)
    assert run(docs(spark, texts)) == brute(list(enumerate(texts)))


def test_family_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    draw = random.Random(2)
    texts = [edited(draw, words(60, family), draw.choice([1, 2, 3])) for family in range(2) for _ in range(45)]
    assert run(docs(spark, texts)) == brute(list(enumerate(texts)))


def test_near_copies_of_passages_that_many_share(spark):
    """Buckets are led by documents that are far from the others, of which some are near copies."""
    texts, last = [], []
    for g in range(4):
        parts = [words(40, 100 * g + i) for i in range(5)]
        both = [a + b for a, b in combinations(parts, 2)]
        texts += [" ".join(w + words(120, 10**6 + 1000 * g + 100 * k + j)) for k, w in enumerate(both) for j in range(6)]
        last += [" ".join(sum(order, [])) for order in (parts, parts[::-1])]
    texts += last
    assert run(docs(spark, texts)) == brute(list(enumerate(texts)))


def test_chain_joins_ends_that_are_not_linked(spark):
    w = words(120)
    texts = [" ".join(w[i * 6 : i * 6 + 80]) for i in range(6)]
    assert {v[1] for v in run(docs(spark, texts)).values()} == {0}


def test_awkward_rows(spark):
    texts = [None, "", " \t\n", "a b", "A  b", "a b c d e", "a b c d e", "É f g h i", "é f g h i", "x y z", (None, "a b"), "b a"]
    rows = minhash.near_duplicates(docs(spark, texts, extra=True)).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert [got[i] for i in range(3)] == [(0, i, True) for i in range(3)]
    assert got[3] == (1, 3, True) and got[4] == (1, 3, False) and got[6] == (1, 5, False)
    # Only A-Z are lower-cased, only ASCII white space separates, order counts.
    assert got[7][1] == 7 and got[8][1] == 8 and got[9][0] == 1 and got[11] == (1, 11, True)
    assert got[None] == (1, None, True)
    assert run(docs(spark, []).limit(0)) == {}


def test_drop_keeps_one_of_each_component(spark):
    frame = docs(spark, ["a b c d e f", "a b c d e f", (3, "q r s"), (3, "q r s"), (None, "a b c d e f"), None], extra=True)
    out = minhash.drop_near_duplicates(frame)
    assert out.columns == frame.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in out.collect() if r["doc_id"] is not None) == [(False, 0), (False, 3), (False, 5)]
    assert out.where("doc_id is null").count() == 1
