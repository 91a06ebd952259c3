"""Increments with late rows: each row once, whenever it appears."""

import datetime

import pytest
from pyspark.sql import functions as F

from tablepull.operators.late import late_increment
from tablepull.spec import SpecError

SCHEMA = "id long, at timestamp_ntz, v int"


def day(d, h=0):
    return datetime.datetime(2024, 1, d, h)


def run(table, path, commit=True, overlap="2 days", column="at"):
    done = late_increment(table, column, ["id"], path, overlap)
    if commit:
        done.commit()
    return sorted((r["id"] is None, r["id"], r["v"]) for r in done.batch.collect()), done.mark


def ids(found):
    return [i for _, i, _ in found[0]]


def test_late_rows_come_once(spark, tmp_path):
    path = str(tmp_path / "s")
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    rows = [(1, day(1), 0), (2, day(5), 0), (3, day(6), 0), (4, None, 0), (None, day(6), 0)]
    first = run(make(rows), path)
    assert ids(first) == [1, 2, 3, 4, None] and first[1].startswith("2024-01-06")
    assert ids(run(make(rows), path)) == []
    # Late within the stretch, late below it, without a value, one on the mark, a changed row, a new one.
    rows += [(10, day(4, 12), 0), (11, day(3), 0), (12, None, 0), (13, day(6), 0), (2, day(5), 9), (14, day(8), 0)]
    assert ids(run(make(rows), path)) == [10, 13, 14]
    assert ids(run(make(rows), path)) == []
    rows += [(15, day(6), 0), (16, day(5, 23), 0), (3, day(9), 1)]
    assert run(make(rows), path)[0] == [(False, 3, 1), (False, 15, 0)]


def test_a_run_that_is_not_committed_is_sent_again(spark, tmp_path):
    path = str(tmp_path / "s")
    table = spark.createDataFrame([(i, day(1 + i % 9), 0) for i in range(50)], SCHEMA)
    assert len(ids(run(table, path, commit=False))) == 50
    assert len(ids(run(table, path))) == 50
    one, two = (late_increment(table.unionByName(spark.createDataFrame([(99, day(9), 0)], SCHEMA)), "at", ["id"], path, "1 day") for _ in range(2))
    one.commit()
    with pytest.raises(SpecError, match="Another run"):
        two.commit()


def test_many_keys_and_numbers(spark, tmp_path):
    """Each of ten thousand rows arrives once over four runs, in whatever order they appear."""
    path = str(tmp_path / "s")
    table = spark.range(10_000).select("id", (F.col("id") * 10).alias("at"), F.pmod(F.hash("id"), F.lit(5)).alias("v"))
    seen = []
    for until in range(1, 5):
        there = table.filter((F.col("at") < until * 25_000) & ((F.col("v") != 0) | (F.col("at") < until * 25_000 - 9_000)))
        seen += ids(run(there, path, overlap="12000"))
    seen += ids(run(table, path, overlap="12000"))
    assert sorted(seen) == list(range(10_000))


def test_empty_tables_and_refusals(spark, tmp_path):
    path, empty = str(tmp_path / "s"), spark.createDataFrame([], SCHEMA)
    assert run(empty, path) == ([], None)
    assert ids(run(spark.createDataFrame([(1, day(2), 0)], SCHEMA), path)) == [1]
    assert run(empty, path)[0] == []
    with pytest.raises(SpecError, match="not found"):
        late_increment(empty, "at", ["nope"], path, "1 day")
    with pytest.raises(SpecError):
        late_increment(spark.createDataFrame([("a", 1)], "id string, v int"), "id", ["id"], path, "1")
