"""Windows with late rows and sessions, over streams that come in several deliveries."""

import datetime
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablepull.spec import SpecError
from tablepull.streaming.sessions import Sessions, closed_sessions, merged, open_sessions, session_new
from tablepull.streaming.windows import closed_windows, late_rows, open_windows, window_new

SCHEMA = "k string, at timestamp_ntz, v double"
HOUR = datetime.timedelta(hours=1)
START = datetime.datetime(2024, 1, 1)


def send(spark, rows, base):
    frame = spark.createDataFrame(rows, SCHEMA)
    frame.coalesce(1).write.mode("append").parquet(f"{base}/in")
    return frame.schema


def test_windows_and_late_rows_add_up(spark, tmp_path):
    base, rng = str(tmp_path), random.Random(0)
    deliveries = []
    for i in range(3):
        rows = [(rng.choice("ab"), START + HOUR * (10 * i + rng.uniform(-12, 10)), float(rng.randrange(9))) for _ in range(80)]
        deliveries.append([*rows, ("a", None, 1.0)])
    want, late, mark = {}, [], None
    for rows in deliveries:
        schema = send(spark, rows, base)
        window_new(spark, f"{base}/in", schema, base, "at", ["k"], "v", "2 hours", "3 hours")
        for k, at, v in rows:
            start = None if at is None else START + 2 * HOUR * ((at - START) // (2 * HOUR))
            if at is None or (mark is not None and start + 2 * HOUR <= mark):
                late.append((k, at, v))
            else:
                want.setdefault((start, k), []).append(v)
        latest = max(r[1] for d in deliveries[: deliveries.index(rows) + 1] for r in d if r[1])
        mark = latest.replace(microsecond=latest.microsecond // 1000 * 1000) - 3 * HOUR
    closed, open_ = closed_windows(spark, base, schema, ["k"], "v"), open_windows(spark, base, ["k"])
    assert closed.count() > 5 and open_.count() > 0
    got = {(r["window_start"], r["k"]): (r["n"], r["lowest"], r["highest"]) for r in closed.unionByName(open_).collect()}
    assert got == {w: (len(v), min(v), max(v)) for w, v in want.items()}
    assert sorted(map(tuple, late_rows(spark, base, schema).collect()), key=str) == sorted(late, key=str)
    assert sum(n for n, _, _ in got.values()) + len(late) == sum(map(len, deliveries))
    # What is closed is out of the state.
    assert closed.join(open_, ["window_start", "k"]).count() == 0


def test_windows_take_a_batch_that_runs_again_once(spark, tmp_path):
    base = str(tmp_path)
    schema = send(spark, [("a", START, 1.0), ("a", START + 9 * HOUR, 2.0)], base)
    window_new(spark, f"{base}/in", schema, base, "at", ["k"], "v")
    for name in os.listdir(tmp_path / "split" / "commits"):
        os.remove(tmp_path / "split" / "commits" / name)
    window_new(spark, f"{base}/in", schema, base, "at", ["k"], "v")
    assert late_rows(spark, base, schema).count() == 0
    assert spark.read.schema(schema).parquet(f"{base}/in_time/*").count() == 2
    with pytest.raises(SpecError, match="not found"):
        window_new(spark, f"{base}/in", schema, base, "nope", ["k"], "v")


def test_sessions_merge():
    assert merged([], np.array([5, 1, 30]), 10) == [(1, 5, 2), (30, 30, 1)]
    # A row between two sessions joins them; a gap of exactly the bound parts them.
    assert merged([(0, 5, 2), (20, 22, 1)], np.array([13]), 10) == [(0, 22, 4)]
    assert merged([(0, 5, 2)], np.array([15]), 10) == [(0, 5, 2), (15, 15, 1)]
    assert merged([(0, 50, 9)], np.array([7, 7]), 10) == [(0, 50, 11)]
    assert merged([], np.array([]), 10) == []


def test_sessions_over_deliveries(spark, tmp_path):
    """Rows out of order join sessions of earlier batches; sessions that are over leave the state."""
    base = str(tmp_path)
    at = lambda h: START + HOUR * h
    first = [("a", at(0), 0.0), ("a", at(1), 0.0), ("a", at(5), 0.0), ("b", at(2), 0.0), ("b", None, 0.0), (None, at(3), 0.0)]
    second = [("a", at(3), 0.0), ("a", at(30), 0.0), ("c", at(30.5), 0.0)]
    third = [("a", at(31), 0.0), ("a", at(60), 0.0)]
    for rows in (first, second, third):
        schema = send(spark, rows, base)
        session_new(spark, f"{base}/in", schema, base, ["k"], "at", 9000, "10 hours")
    facts = lambda df: sorted(((r["k"], r["session_start"], r["session_end"], r["n"]) for r in df.collect()), key=str)
    closed, open_ = closed_sessions(spark, base, schema, ["k"]), open_sessions(spark, base, ["k"])
    assert facts(closed) == sorted([("a", at(0), at(5), 4), ("b", at(2), at(2), 1), (None, at(3), at(3), 1), ("a", at(30), at(31), 2), ("c", at(30.5), at(30.5), 1)], key=str)
    assert facts(open_) == [("a", at(60), at(60), 1)]
    keys = spark.read.format("statestore").option("stateVarName", "open").load(f"{base}/sessions").select(F.col("key.k")).collect()
    assert [r["k"] for r in keys] == ["a"]
    with pytest.raises(SpecError, match="not found"):
        session_new(spark, f"{base}/in", schema, base, ["nope"], "at", 1)


class Held:
    """The state of one key, and the timers set for it."""

    def __init__(self):
        self.value, self.timers, self.calls, self.now = None, [], 0, 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.value

    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value, self.calls = value, self.calls + 1

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.timers.append(at)

    def getCurrentWatermarkInMs(self):
        return self.now

    def getExpiryTimeInMs(self):
        return self.fired


def test_a_key_has_one_timer_for_all_its_sessions():
    held, processor = Held(), Sessions(1_000_000, ["k"])
    processor.init(held)
    rows = lambda *seconds: iter([{"session_row_micros": s * 1_000_000} for s in seconds])
    assert list(processor.handleInputRows(("a",), rows(50, 10, 30, 20, 40), held)) == []
    assert held.timers == [11_000] and held.calls == 1
    # A later row needs no timer, an earlier one does.
    assert list(processor.handleInputRows(("a",), rows(60), held)) == [] and held.timers == [11_000]
    assert list(processor.handleInputRows(("a",), rows(5), held)) == [] and held.timers == [11_000, 6_000]
    held.now, held.fired = 35_000, 6_000
    (row,) = processor.handleExpiredTimer(("a",), held, held)
    assert row["session_starts"] == [s * 1_000_000 for s in (5, 10, 20, 30)] and row["session_counts"] == [1] * 4 and held.timers[2:] == [41_000]
    # The one left behind finds nothing that is over.
    held.fired, calls = 11_000, held.calls
    assert list(processor.handleExpiredTimer(("a",), held, held)) == [] and held.calls == calls
    held.now, held.fired = 99_000, 41_000
    (row,) = processor.handleExpiredTimer(("a",), held, held)
    assert len(row["session_ends"]) == 3 and held.value is None and held.timers[4:] == []
    assert list(processor.handleExpiredTimer(("a",), held, held)) == []


def test_sessions_keep_their_keys(spark, tmp_path):
    """Keys of any type, null among them, and sessions to the microsecond."""
    base, day = str(tmp_path), datetime.date(2024, 2, 29)
    at = START + datetime.timedelta(microseconds=7)
    for rows in ([(2**60 + 1, day, START, at), (None, None, None, at), (2**60 + 1, day, START, at + 5 * HOUR)], [(1, day, START, at + 90 * HOUR)]):
        frame = spark.createDataFrame(rows, "i bigint, d date, t timestamp_ntz, at timestamp_ntz")
        frame.coalesce(1).write.mode("append").parquet(f"{base}/in")
        session_new(spark, f"{base}/in", frame.schema, base, ["i", "d", "t"], "at", 3600, "1 hour")
    closed, open_ = (f(spark, base, *a).collect() for f, a in ((closed_sessions, (frame.schema, ["i", "d", "t"])), (open_sessions, (["i", "d", "t"],))))
    assert sorted(map(tuple, closed), key=str) == sorted([(2**60 + 1, day, START, at, at, 1), (2**60 + 1, day, START, at + 5 * HOUR, at + 5 * HOUR, 1), (None, None, None, at, at, 1)], key=str)
    assert [tuple(r) for r in open_] == [(1, day, START, at + 90 * HOUR, at + 90 * HOUR, 1)]
