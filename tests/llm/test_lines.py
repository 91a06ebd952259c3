"""Line dedup against comparing every line with every earlier one."""

import random

import pytest
from llm.fixtures import docs

from tablepull.llm.lines import MIN_WORDS, NEAR_WORDS, dedup_lines


def within_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows):
    """Texts by id, for unique ids."""
    seen, out = [], {}
    for i, t in sorted(rows):
        kept = []
        for line in (t or "").split("\n"):
            w = line.strip(" \t\x0b\f\r").lower().split()
            near = len(w) >= NEAR_WORDS and any(len(o) >= NEAR_WORDS and within_one(w, o) for o in seen)
            gone = len(w) >= MIN_WORDS and (w in seen or near)
            seen.append(w)
            if not gone:
                kept.append(line)
        out[i] = None if t is None else "\n".join(kept)
    return out


def run(frame):
    return {r["doc_id"]: r["text"] for r in dedup_lines(frame).collect()}


def test_random_edits_equal_brute_force(spark):
    draw = random.Random(5)
    base = [[draw.choice("abcdefgh") + str(draw.randint(0, 30)) for _ in range(draw.randint(2, 14))] for _ in range(25)]
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(draw.randint(1, 5)):
            line = list(draw.choice(base))
            for _ in range(draw.choice([0, 0, 1, 1, 2])):
                at = draw.randrange(len(line))
                kind = draw.choice("rid")
                line[at : at + (kind != "i")] = [] if kind == "d" else [draw.choice(["zz", "yy", line[at]])]
            lines.append(draw.choice([" ", "  ", "\t"]).join(line).title() if draw.random() < 0.3 else " ".join(line))
        texts.append("\n".join(lines))
    assert run(docs(spark, texts)) == brute(list(enumerate(texts)))


@pytest.mark.parametrize("at", range(9))
def test_one_word_at_every_place(spark, at):
    line = [f"w{i}" for i in range(9)]
    changed, shorter, longer = line[:at] + ["new"] + line[at + 1 :], line[:at] + line[at + 1 :], line[:at] + ["new"] + line[at:]
    texts = [" ".join(line)] + [" ".join(x) + "\nrest" for x in (changed, shorter, longer)]
    assert [run(docs(spark, texts))[i] for i in (1, 2, 3)] == ["rest"] * 3


def test_repeated_words_and_two_edits_stay(spark):
    line = "a a b b a a b b a a"
    texts = [line, line + " a a", "b b " + line, "a a a b b a a b b a a"]
    assert run(docs(spark, texts)) == brute(list(enumerate(texts)))


def test_awkward_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    texts = [None, "", "\n\n", "one two", "one two", "x y z\n\nX  y\tz", (None, "x y z"), (None, "x y z"), long, long + " more", long]
    frame = docs(spark, texts, extra=True)
    out = dedup_lines(frame, counts=("lines", "gone"))
    assert out.columns == frame.columns + ["lines", "gone"]
    rows = out.collect()
    assert len(rows) == len(texts)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["text"], r["lines"], r["gone"]))
    # A null id comes first, so its two equal rows keep the line and the later document loses both.
    assert by[None] == [("x y z", 1, 0)] * 2
    assert by[5] == [("", 3, 2)] and by[0] == [(None, 0, 0)] and by[1] == [("", 1, 0)] and by[2] == [("\n\n", 3, 0)]
    assert by[3] == by[4] == [("one two", 1, 0)]
    assert by[8][0][2] == 0 and by[9] == [("", 1, 1)] and by[10] == [("", 1, 1)]


def test_empty_table(spark):
    assert dedup_lines(docs(spark, []).limit(0)).collect() == []
