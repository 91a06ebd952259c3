"""Differences of two versions against a loop, and what is read for them."""

import datetime
import random

import pytest

from tablepull.operators.snapshots import FILTER_RANGES, differing_leaves, leaf_bits, opened, snapshot_diff, write_digests
from tablepull.spec import SpecError

SCHEMA = "id long, name string, v double, m map<string,int>"


def brute(old, new, key=lambda r: r[0]):
    a, b = {key(r): r for r in old}, {key(r): r for r in new}
    out = [("insert", *b[k]) for k in b.keys() - a.keys()] + [("delete", *a[k]) for k in a.keys() - b.keys()]
    return sorted(out + [("update", *b[k]) for k in a.keys() & b.keys() if a[k] != b[k]], key=str)


def diff(spark, old, new, path, schema=SCHEMA, keys=("id",), leaf_rows=10):
    frames = [spark.createDataFrame(rows, schema) for rows in (old, new)]
    bits = leaf_bits(frames[0], keys, leaf_rows)
    for frame, name in zip(frames, "on"):
        write_digests(frame.repartition(3), keys, f"{path}/{name}", bits)
    got = snapshot_diff(*frames, keys, f"{path}/o", f"{path}/n", bits)
    assert got.columns == ["change", *frames[0].columns]
    return sorted(map(tuple, got.collect()), key=str), differing_leaves(spark, f"{path}/o", f"{path}/n", bits)


def rows(n, seed, step=3):
    rng = random.Random(seed)
    return [(i * step - n, rng.choice(["a", None, "b"]), rng.choice([0.5, None]), {"k": i % 3}) for i in range(n)]


@pytest.mark.parametrize("leaf_rows", [10, 100_000])
def test_equals_a_loop(spark, tmp_path, leaf_rows):
    old = [*rows(1000, 1), (None, "null key", 1.0, None), (-(2**63), "low", 1.0, None), (2**63 - 1, "high", 1.0, None)]
    new = [r for r in old if r[0] != 20] + [(1, "in", None, {}), (10**12, "far", 2.0, None)]
    new = [(k, "other", v, m) if k in (-997, 2**63 - 1, None) else (k, n, v, {"k": 9}) if k == 50 else (k, n, v, m) for k, n, v, m in new]
    got, _ = diff(spark, old, new, tmp_path, leaf_rows=leaf_rows)
    assert got == brute(old, new) and len(got) == 7


def test_equal_ranges_are_not_opened(spark, tmp_path):
    old = rows(2000, 2)
    new = [(k, "x" if 100 <= k < 130 else n, v, m) for k, n, v, m in old]
    got, leaves = diff(spark, old, new, tmp_path)
    assert got == brute(old, new)
    found = [r["node"] for r in leaves.collect()]
    assert 1 <= len(found) <= 3
    spark.createDataFrame(old, SCHEMA).write.parquet(str(tmp_path / "t"))
    part = opened(spark.read.parquet(str(tmp_path / "t")), ["id"], leaves, leaf_bits(spark.createDataFrame(old, SCHEMA), ["id"], 10))
    assert part.count() <= 60
    assert "PushedFilters: [Or" in part._jdf.queryExecution().toString() or "GreaterThanOrEqual(id" in part._jdf.queryExecution().toString()
    same, none = diff(spark, old, list(reversed(old)), tmp_path / "same")
    assert same == [] and none.count() == 0


def test_many_changes_are_joined(spark, tmp_path):
    """More ranges than a filter should hold."""
    old = rows(20 * FILTER_RANGES, 3, 40)
    new = [(k, n, -1.0 if i % 8 == 0 else v, m) for i, (k, n, v, m) in enumerate(old)]
    got, leaves = diff(spark, old, new, tmp_path, leaf_rows=2)
    assert leaves.count() > FILTER_RANGES and got == brute(old, new)


def test_keys_of_text_times_and_several_columns(spark, tmp_path):
    old = [(f"k{i}", i % 4, i) for i in range(300)]
    new = [r for r in old if r[2] != 7] + [("new", None, 1)]
    got, _ = diff(spark, old, new, tmp_path / "a", "a string, b int, c int", ("a", "b"))
    assert got == brute(old, new, lambda r: r[:2])
    day = datetime.datetime(2024, 1, 1)
    old = [(day + datetime.timedelta(hours=i), i) for i in range(200)]
    new = [(t, -i if i == 9 else i) for t, i in old[:-1]]
    got, _ = diff(spark, old, new, tmp_path / "b", "t timestamp_ntz, i int", ("t",))
    assert got == brute(old, new)


def test_empty_versions_and_refusals(spark, tmp_path):
    some = rows(5, 4)
    assert diff(spark, [], some, tmp_path / "a")[0] == brute([], some)
    assert diff(spark, some, [], tmp_path / "b")[0] == brute(some, [])
    assert diff(spark, [], [], tmp_path / "c")[0] == []
    frame = spark.createDataFrame(some, SCHEMA)
    with pytest.raises(SpecError, match="different columns"):
        snapshot_diff(frame, frame.drop("v"), ["id"], "x", "y", 0)
    with pytest.raises(SpecError, match="no leaves"):
        differing_leaves(spark, str(tmp_path / "a/o"), str(tmp_path / "a/n"), 13)
