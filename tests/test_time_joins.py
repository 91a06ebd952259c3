"""As-of and overlap joins against loops over all pairs."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tablepull.operators import overlap
from tablepull.operators.asof import asof_join
from tablepull.operators.overlap import overlap_join
from tablepull.spec import SpecError

LEFT, RIGHT = "k string, t long, id long", "k string, at long, tie int, v string"


def asof_brute(left, right, strict):
    out = []
    for k, t, i in left:
        fits = [] if k is None or t is None else [r for r in right if r[0] == k and r[1] is not None and (r[1] < t or (r[1] == t and not strict))]
        best = max(fits, key=lambda r: (r[1], r[2], r[3]), default=None)
        out.append((k, t, i, best[1] if best else None, best[3] if best else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("part_rows", [7, 40, 1_000_000])
def test_asof_equals_a_loop(spark, strict, part_rows):
    """Half of the rows have one key; many share a time; some keys and times are NULL, some rows repeat."""
    rng = random.Random(part_rows)
    key = lambda: rng.choice(["hot", "hot", "hot", "a", "b", "c", None])
    left = [(key(), rng.choice([None, *range(40)]), i) for i in range(150)] + [("hot", 20, 999)] * 9
    right = [(key(), rng.choice([None, *range(0, 40, 3)]), rng.randrange(3), f"v{i}") for i in range(120)]
    got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "t", "at", {"at": "last_at", "v": "last_v"}, strict, [F.col("tie")], part_rows)
    assert got.columns == ["k", "t", "id", "last_at", "last_v"]
    assert sorted(map(tuple, got.collect()), key=str) == asof_brute(left, right, strict)


def test_asof_carries_over_many_parts(spark):
    """One right row at the start of a key is the last one of rows many parts later."""
    left = [("k", t, t) for t in range(1, 60)] + [("l", t, t) for t in range(5)]
    right = [("k", 0, 0, "first"), ("l", 100, 0, "later")]
    got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "t", "at", {"v": "v"}, part_rows=4)
    assert {(r["k"], r["v"]) for r in got.collect()} == {("k", "first"), ("l", None)} and got.count() == 64


def test_asof_empty_sides_and_refusals(spark):
    left, right = spark.createDataFrame([("k", 1, 1)], LEFT), spark.createDataFrame([("k", 1, 0, "x")], RIGHT)
    assert asof_join(left, right.limit(0), ["k"], "t", "at", {"v": "v"}).collect() == [("k", 1, 1, None)]
    assert asof_join(left.limit(0), right, ["k"], "t", "at", {"v": "v"}).count() == 0
    with pytest.raises(SpecError, match="not found"):
        asof_join(left, right, ["k"], "t", "at", {"nope": "v"})
    with pytest.raises(SpecError, match="already"):
        asof_join(left, right, ["k"], "t", "at", {"v": "id"})


INTERVAL = "k string, low long, high long, id long"


def intervals(n, seed, span=4000):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        low = rng.randrange(-span, span)
        out.append((rng.choice(["hot", "hot", "a", None]), rng.choice([low, low, None]) if i % 10 == 0 else low, low + rng.choice([0, 1, 2, 3, 4, 7, 8, 9, 60, 500, 2 * span, -5]), i))
    return out


def overlap_brute(left, right):
    whole = lambda rows: [r for r in rows if None not in r and r[1] < r[2]]
    return sorted((a[3], b[3]) for a in whole(left) for b in whole(right) if a[0] == b[0] and a[1] < b[2] and b[1] < a[2])


@pytest.mark.parametrize("bucket_rows", [200_000, 5])
def test_overlap_equals_a_loop(spark, bucket_rows):
    left, right = intervals(300, 1) + [("hot", 5, 6, 1000)] * 3, intervals(250, 2)
    a, b = spark.createDataFrame(left, INTERVAL), spark.createDataFrame(right, INTERVAL)
    got = overlap_join(a, b, ["k"], ("low", "high"), ("low", "high"), {"id": "left_id"}, {"id": "right_id"}, bucket_rows)
    want = overlap_brute(left, right)
    assert len(want) > 1000 and sorted(map(tuple, got.collect())) == want
    same = overlap_join(a, a, ["k"], ("low", "high"), ("low", "high"), {"id": "left_id"}, {"id": "right_id"}, bucket_rows)
    assert sorted(map(tuple, same.collect())) == overlap_brute(left, left)


def test_overlap_of_times_dates_and_no_key(spark):
    day = lambda d, h=0: datetime.datetime(2024, 1, d, h)
    a = spark.createDataFrame([(1, day(1), day(2)), (2, day(3), day(3, 1)), (3, datetime.datetime(1960, 1, 1), day(9))], "i int, s timestamp_ntz, e timestamp_ntz")
    b = spark.createDataFrame([(1, day(2), day(3)), (2, day(1, 23), day(3, 1)), (3, day(3), day(4))], "j int, s timestamp_ntz, e timestamp_ntz")
    got = overlap_join(a, b, [], ("s", "e"), ("s", "e"), {"i": "i"}, {"j": "j"})
    want = {(1, 2), (2, 2), (2, 3), (3, 1), (3, 2), (3, 3)}
    assert {tuple(r) for r in got.collect()} == want and got.count() == 6
    c, d = (t.withColumn("s", F.to_date("s")).withColumn("e", F.to_date("e")) for t in (a, b))
    assert {tuple(r) for r in overlap_join(c, d, [], ("s", "e"), ("s", "e"), {"i": "i"}, {"j": "j"}).collect()} == {(1, 2), (3, 1), (3, 2), (3, 3)}


def test_overlap_empty_sides_and_refusals(spark):
    a = spark.createDataFrame([("k", 1, 5, 1)], INTERVAL)
    assert overlap_join(a.limit(0), a, ["k"], ("low", "high"), ("low", "high"), {"id": "x"}, {"id": "y"}).count() == 0
    assert overlap_join(a, a.limit(0), ["k"], ("low", "high"), ("low", "high"), {"id": "x"}, {"id": "y"}).count() == 0
    for arguments, message in ((({"id": "x"}, {"id": "x"}), "Both sides"), (({"id": "x"}, {"k": "y"}), "whole number")):
        bounds = ("k", "high") if "whole" in message else ("low", "high")
        with pytest.raises(SpecError, match=message):
            overlap_join(a, a, ["k"], bounds, ("low", "high"), *arguments)


def test_overlap_sends_each_row_to_few_buckets(spark):
    """A row stands in two buckets a level at most, however long the intervals of the table are."""
    rows = spark.createDataFrame(intervals(400, 3, 100_000), INTERVAL)
    leveled = overlap._leveled(rows, ["k"], ("low", "high"), {"id": "id"}, "l")
    levels = [r[0] for r in leveled.select("l_level").distinct().collect()]
    spread = overlap._spread(leveled, "l", levels, dict.fromkeys(levels, 1), 0)
    most = spread.groupBy("l", "level", "l_home").count().agg(F.max("count")).first()[0]
    assert most == 2 and spread.count() <= 4 * len(levels) * leveled.count()
