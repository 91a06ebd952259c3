"""One CSV file read in byte ranges of any size, whatever its values hold."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablepull.operators import sinks
from tablepull.operators.sinks import read_csv, write_csv
from tablepull.session import with_session
from tablepull.sources.csv_split import csv_records, read_csv_split


def small(spark, size):
    return with_session(spark, {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"})


def texts(n, seed):
    rng = random.Random(seed)
    parts = ['"', '""', "\n", "\n\n", ",", "a", "some words", "\r\n", "\\", " ", "é\U0001f600", '"\n"', '",\n"', ""]
    return [None if rng.random() < 0.1 else "".join(rng.choices(parts, k=rng.randrange(9))) for _ in range(n)]


@pytest.mark.parametrize("size", [40, 300, 1_000_000])
def test_any_range_gives_all_records(spark, tmp_path, size):
    rows = list(zip(range(200), texts(200, size), texts(200, size + 1)))
    frame = spark.createDataFrame(rows, "id int, a string, b string")
    write_csv(frame, str(tmp_path / "t"), records_per_file=0, single_file=True)
    session = small(spark, size)
    got = read_csv_split(session, str(tmp_path / "t"), frame.schema)
    assert got.schema == frame.schema and sorted(map(tuple, got.collect())) == sorted(rows, key=lambda r: r[0])
    ranges = session.read.option("lineSep", "\n").text(str(tmp_path / "t")).select("_metadata.file_block_start").distinct().count()
    assert ranges == 1 if size == 1_000_000 else ranges > 5


def test_values_longer_than_many_ranges(spark, tmp_path):
    rows = [(0, "x\n" * 500 + '"' * 101), (1, "\n" * 300), (2, "y"), (3, None), (4, '"\n' * 200)]
    frame = spark.createDataFrame(rows, "id int, a string")
    write_csv(frame, str(tmp_path / "t"), records_per_file=0, single_file=True)
    assert sorted(map(tuple, read_csv_split(small(spark, 64), str(tmp_path / "t"), frame.schema).collect())) == rows


def test_awkward_texts_and_several_files(spark, escaping, tmp_path):
    write_csv(escaping.repartition(3), str(tmp_path / "t"))
    for size in (16, 1000):
        got = read_csv_split(small(spark, size), str(tmp_path / "t"), escaping.columns)
        want = read_csv(spark, str(tmp_path / "t"), escaping.columns)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str) == sorted(map(tuple, escaping.collect()), key=str)
    # Records stand as in the file.
    lines = [r["record"] for r in csv_records(small(spark, 16), str(tmp_path / "t")).collect()]
    assert '"two\nlines","a \t tab"' in lines and len(lines) == escaping.count()


def test_one_column(spark, tmp_path):
    frame = spark.createDataFrame([("a\n\nb",), (None,), ("",), ('"\n',), (None,)], "v string")
    write_csv(frame, str(tmp_path / "t"), records_per_file=0, single_file=True)
    for size in (4, 1000):
        assert sorted(map(tuple, read_csv_split(small(spark, size), str(tmp_path / "t"), ["v"]).collect()), key=str) == sorted(map(tuple, frame.collect()), key=str)


def test_types_come_back(spark, tmp_path):
    row = (7, -(2**40), Decimal("5.100"), True, 0.1, 1e300, datetime.date(2020, 2, 29), datetime.datetime(2021, 1, 5, 13, 43, 17, 12), "x,\n\"", bytearray(b"\x00\xff"), [1, None], {"k": 1})
    schema = "i int, l bigint, d decimal(10,3), b boolean, f double, g double, day date, at timestamp_ntz, t string, x binary, a array<int>, m map<string,int>"
    frame = spark.createDataFrame([row, (None,) * 12], schema)
    write_csv(frame, str(tmp_path / "t"), records_per_file=0, single_file=True)
    got = read_csv_split(spark, str(tmp_path / "t"), frame.schema).orderBy(F.col("i").asc_nulls_last()).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in frame.collect()]


@pytest.mark.parametrize("piece", [1 << 27, 700])
def test_many_tasks_write_one_file(spark, tmp_path, monkeypatch, piece):
    """No task holds all rows; they stand in the file in the frame's order."""
    monkeypatch.setattr(sinks, "PIECE_BYTES", piece)
    frame = spark.range(0, 1000, 1, 4).select("id", F.spark_partition_id().alias("task"), F.lit('é\n"').alias("text"))
    path = tmp_path / "t"
    for _ in range(2):
        result = write_csv(frame, str(path), "id", records_per_file=0, single_file=True)
    assert (result.rows, result.last_value) == (1000, "999")
    assert len([p for p in path.iterdir() if p.name.startswith("part-")]) == 1 and not (tmp_path / "t.parts").exists()
    rows = read_csv(spark, str(path), frame.columns).collect()
    assert [r["id"] for r in rows] == [str(i) for i in range(1000)] and {r["text"] for r in rows} == {'é\n"'}
    assert {r["task"] for r in rows} == {"0", "1", "2", "3"}
    assert write_csv(frame.limit(0), str(path), single_file=True).rows == 0 and not path.exists()
