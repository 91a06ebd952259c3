import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablepull import SpecError, TableSpec
from tablepull.operators.increment import (
    bounded_increment,
    guard_progress,
    increment_health,
    last_watermark,
    max_watermark,
    read_mark,
    run_increment,
    since,
)
from tablepull.operators.toplimit import limit_batch
from tablepull.sources.scan import balanced_cuts, even_cuts, jdbc_options, scan_query, scan_table, stride_counts, stride_predicates

ID, DECIMAL, TIME = "_Weir%d I-D", "someDecimal", "datetime"


def ids(df):
    return sorted(row[ID] for row in df.collect())


# (column, state, limit) -> (ids, state after)
RUNS = [
    (ID, None, None, [1, 2, 3, 4, 5, 6], "6"),
    (ID, "4", None, [4, 5, 6], "6"),
    (ID, None, 2, [1, 2], "2"),
    (ID, "2", 2, [2, 3], "3"),
    (DECIMAL, None, None, [1, 2, 3, 4, 5, 6], "6.60"),
    (DECIMAL, "4.40", None, [4, 5, 6], "6.60"),
    (TIME, None, None, [1, 2, 3, 4, 5, 6], "2021-01-05 13:43:27"),
    (TIME, "2021-01-05 13:43:27", None, [6], "2021-01-05 13:43:27"),
]


@pytest.mark.parametrize("column, state, limit, expected, after", RUNS)
def test_runs(spark, increments, column, state, limit, expected, after):
    batch, new = run_increment(increments, column, state, limit)
    assert (ids(batch), new) == (expected, after)


def test_empty_increment_keeps_the_state(spark, increments):
    for limit in (None, 2):
        batch, state = run_increment(increments.filter("false"), ID, "3", limit)
        assert (batch.count(), state) == (0, "3")
    assert run_increment(increments.filter("false"), ID, None)[1] is None


def test_wrong_columns_are_refused(increments):
    with pytest.raises(SpecError, match="was not found in the table"):
        run_increment(increments, "fakeCol", None)
    with pytest.raises(SpecError, match='unexpected type "STRING"'):
        run_increment(increments, "Weir%d Na-me", None)
    with pytest.raises(SpecError, match='unexpected type "DATE"'):
        since(increments.withColumn("d", F.col("datetime").cast("date")), "d", None)


def test_stalled_increment_is_refused(increments):
    state = "2021-01-05 13:43:17"
    with pytest.raises(SpecError, match="stalls"):
        run_increment(increments, TIME, state, 2)
    batch, after = run_increment(increments, TIME, state, 6)
    assert (batch.count(), after) == (6, "2021-01-05 13:43:27")
    guard_progress(2, 0, 1, "1", "c")


def test_caught_up_increment_sends_its_boundary_again(increments):
    last = "2021-01-05 13:43:27"
    batch, after = run_increment(increments, TIME, last, 1)
    assert (ids(batch), after) == ([6], last)


def test_rows_without_a_value(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    batch, state = run_increment(df, "v", None)
    assert (batch.count(), state) == (3, "3")
    assert run_increment(df, "v", "1")[0].count() == 2
    batch, state = run_increment(df, "v", None, 2)
    assert (sorted(r["v"] for r in batch.collect()), state) == ([1, 3], "3")
    assert bounded_increment(df.filter("v is null"), "v", None, None).count() == 1


def test_frozen_mark_leaves_later_rows(increments):
    rows = bounded_increment(increments, ID, "2", "4")
    assert ids(rows) == [2, 3, 4]
    assert read_mark(last_watermark(rows, ID)) == "4"
    assert read_mark(max_watermark(increments, DECIMAL)) == "6.60"


def test_filter_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = since(events, "ts", "2024-01-20 00:00:00")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts" in plan


def test_health(spark, increments):
    facts = increment_health(increments.unionByName(increments.withColumn(TIME, F.lit(None).cast("timestamp_ntz"))), TIME).first()
    assert tuple(facts) == (12, 6, "2021-01-05 13:43:17", "2021-01-05 13:43:27", 1, 5)
    assert tuple(increment_health(increments.filter("false"), TIME).first()) == (0, 0, None, None, None, None)


# Large limits, cut by value, against a plain sort


def first_rows(rows, n, *keys):
    order = lambda row: tuple((row[k] is None, row[k] if row[k] is not None else 0) for k in keys)
    return sorted(rows, key=order)[:n]


def cut(df, n, heap_rows=5, column="k", tie_break=()):
    return [tuple(r) for r in limit_batch(df, column, n, tie_break, heap_rows=heap_rows).collect()]


@pytest.mark.parametrize("n", [6, 333, 999, 1000])
def test_large_limit_unique(spark, n):
    rows = [(i * 7919 % 1000, f"x{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, t string").repartition(4)
    assert sorted(cut(df, n)) == first_rows(rows, n, 0)


@pytest.mark.parametrize("n", [10, 450, 950])
def test_large_limit_with_a_hot_value_and_nulls(spark, n):
    rnd = random.Random(n)
    keys = [50] * 400 + [None] * 100 + [rnd.randrange(100) for _ in range(500)]
    rows = [(key, f"t{i:04d}") for i, key in enumerate(keys)]
    df = spark.createDataFrame(rows, "k int, t string").repartition(4)
    got = cut(df, n, tie_break=("t",))
    assert sorted(got, key=str) == sorted(first_rows(rows, n, 0, 1), key=str)


@pytest.mark.parametrize("n", [300, 700])
def test_large_limit_without_tie_break_takes_exactly_n(spark, n):
    """Ties that nothing orders, copies included: any of them will do, but not one too many."""
    rows = [(1, f"a{i}") for i in range(200)] + [(2, "same")] * 600 + [(3, f"c{i}") for i in range(200)]
    got = cut(spark.createDataFrame(rows, "k int, t string").repartition(4), n)
    assert len(got) == n
    assert sorted(got) == sorted(first_rows(rows, n, 0))


@pytest.mark.parametrize(
    "kind, value",
    [
        ("double", lambda i: i / 8 - 3),
        ("decimal(10,2)", lambda i: Decimal(i) / 4),
        ("string", lambda i: f"{i:05d}"),
        ("bigint", lambda i: i - 300),
    ],
)
def test_large_limit_types(spark, kind, value):
    rows = [(value(i * 31 % 500),) for i in range(500)]
    df = spark.createDataFrame(rows, f"k {kind}")
    got = cut(df, 222)
    assert sorted(got) == sorted(rows)[:222]


def test_large_limit_of_timestamps(spark):
    for kind in ("timestamp_ntz", "timestamp"):
        df = spark.range(700).select(F.timestamp_micros(F.col("id") * 333_333_333).cast(kind).alias("k"), "id")
        assert sorted(r[1] for r in limit_batch(df, "k", 321, heap_rows=5).collect()) == list(range(321))


def test_large_limit_with_maps_and_many_copies(spark):
    df = spark.range(900).select(F.lit(1).alias("k"), F.create_map(F.lit("a"), F.col("id") % 3).alias("m"))
    assert limit_batch(df, "k", 700, heap_rows=5).count() == 700


def test_state_of_zoned_timestamps_and_floats(spark):
    df = spark.range(10).select(
        F.timestamp_micros(1_600_000_000_000_000 + F.col("id") * 1_500_000).alias("at"),
        (F.col("id") * 2.5e15).alias("d"),
    )
    for column in ("at", "d"):
        _, state = run_increment(df, column, None, 4)
        batch, after = run_increment(df, column, state)
        assert batch.count() == 7 and after != state
    assert run_increment(df, "at", None)[1] == "2020-09-13 12:26:53.5+00"


def test_large_limit_is_a_filter_and_no_sort(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = limit_batch(lines, "l_extendedprice", 3000, heap_rows=100)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "TakeOrdered" not in plan and "LessThanOrEqual(l_extendedprice" in plan
    small = limit_batch(lines, "l_extendedprice", 50)._jdf.queryExecution().toString()
    assert "Exchange" not in small and "TakeOrdered" not in small


def test_limit_takes_the_same_rows_at_every_heap_and_layout(spark):
    rows = [(i % 7, f"t{i}") for i in range(600)] + [(3, "copy")] * 30
    df = spark.createDataFrame(rows, "k int, t string")
    for n in (1, 100, 270, 300, 629):
        wanted = None
        for heap in (5, 50, 10_000):
            for parts in (1, 3):
                got = sorted(cut(df.repartition(parts), n, heap_rows=heap))
                wanted = wanted or got
                assert got == wanted and len(got) == n
    assert cut(df, 0) == []


# Strides


def test_even_strides(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    cuts = even_cuts(0, 99, 4)
    assert cuts == [24, 48, 72]
    assert {r["stride"]: r["rows"] for r in stride_counts(df, "k", cuts).collect()} == {0: 24, 1: 24, 2: 24, 3: 28}
    assert even_cuts(0, 2, 8) == [1]


def test_balanced_strides(spark):
    """Half of the values lie in a thousandth of the range."""
    df = spark.range(2000).select(F.when(F.col("id") < 1000, F.col("id")).otherwise(F.col("id") * 1000).alias("k"))
    counts = [r["rows"] for r in stride_counts(df, "k", balanced_cuts(df, "k", 4)).collect()]
    assert len(counts) == 4 and max(counts) < 600
    assert max(r["rows"] for r in stride_counts(df, "k", even_cuts(0, 1_999_000, 4)).collect()) > 900


def test_stride_predicates_cover_everything_once(spark):
    df = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], '`a"b` int')
    predicates = stride_predicates('a"b', [10, 20, 35])
    assert len(predicates) == 4
    total = [scan_query(spark, f"SELECT count(*) AS n FROM t WHERE {p}", {"t": df.withColumnRenamed('a"b', "v")}).first()["n"]
             for p in [p.replace('"a""b"', "v") for p in predicates]]
    assert total == [11, 10, 15, 15]
    assert stride_predicates("x", []) == ["1 = 1"]
    assert stride_predicates("x", ["o'k"]) == ["\"x\" < 'o''k' OR \"x\" IS NULL", "\"x\" >= 'o''k'"]


def test_reader_options():
    base = {"url": "jdbc:postgresql://host/db", "user": "u"}
    options = jdbc_options(base, schema="public", table='a"b', init=["SET TIME ZONE 'UTC'", "SET x = 1"])
    assert options["dbtable"] == '"public"."a""b"' and options["fetchsize"] == "10000"
    assert options["sessionInitStatement"] == "SET TIME ZONE 'UTC'; SET x = 1"
    assert jdbc_options(base, query="SELECT\n1; ;", batch_size=500)["query"] == "SELECT\n1"
    parted = jdbc_options(base, query="SELECT * FROM t;", partition=("id", 0, 100, 4))
    assert parted["dbtable"] == "(SELECT * FROM t) t" and "query" not in parted
    assert (parted["partitionColumn"], parted["lowerBound"], parted["upperBound"], parted["numPartitions"]) == ("id", "0", "100", "4")
    with pytest.raises(SpecError):
        jdbc_options(base)


def test_a_spec_sets_its_batch_size(spark):
    def tables(size):
        read = lambda schema, table: spark.range(1).withColumn("size", F.lit(size))
        read.with_batch_size = tables
        return read

    spec = TableSpec.from_config({"table": {"schema": "s", "tableName": "t"}, "batchSize": 500})
    assert scan_table(tables(10_000), spec).first()["size"] == 500


def test_query_scan_is_isolated(spark, increments):
    rows = scan_query(spark, 'SELECT "_Weir%d I-D" AS id\nFROM "my table" ;; ', {"my table": increments})
    assert sorted(r["id"] for r in rows.collect()) == [1, 2, 3, 4, 5, 6]
    assert not spark.catalog.tableExists("`my table`")
    assert scan_query(spark, "SELECT count(*) AS n FROM t", {"t": increments.limit(2)}).first()["n"] == 2
    with pytest.raises(Exception, match="PARSE|syntax"):
        scan_query(spark, "SELEC nothing")
    assert scan_query(spark, "SELECT current_timezone() AS z", conf={"spark.sql.session.timeZone": "Asia/Manila"}).first()["z"] == "Asia/Manila"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
