"""Parallel reads by configuration; the reading itself needs a database and is not run."""

import datetime

import pytest

from tablepull.sources import scan
from tablepull.spec import SpecError, TableSpec

TABLE = {"table": {"schema": "s", "tableName": "t"}}


@pytest.fixture
def calls(spark, monkeypatch):
    made = []

    def partitioned(spark, connection, schema, table, column, cuts, batch_size):
        made.append((schema, table, column, scan.stride_predicates(column, cuts), batch_size))
        return spark.range(3)

    monkeypatch.setattr(scan, "scan_partitioned", partitioned)
    monkeypatch.setattr(scan, "column_bounds", lambda spark, options, schema, table, column: (0, 100))
    return made


def test_a_spec_sets_its_partitions(spark, calls):
    spec = TableSpec.from_config({**TABLE, "partitionColumn": "id", "partitions": 4, "batchSize": 500})
    assert scan.scan_table(scan.jdbc_tables(spark, {"url": "jdbc:x"}), spec).count() == 3
    strides = ['"id" < 25 OR "id" IS NULL', '"id" >= 25 AND "id" < 50', '"id" >= 50 AND "id" < 75', '"id" >= 75']
    assert calls == [("s", "t", "id", strides, 500)]


def test_the_source_sets_them_for_all_specs(spark, calls):
    tables = scan.jdbc_tables(spark, {"url": "jdbc:x"}, partition_column="k", partitions=2)
    scan.scan_table(tables, TableSpec.from_config(TABLE))
    scan.scan_table(tables, TableSpec.from_config({**TABLE, "partitionColumn": "other", "partitions": 3}))
    assert [(c[2], len(c[3]), c[4]) for c in calls] == [("k", 2, 10_000), ("other", 3, 10_000)]


def test_strides():
    assert scan.strides(0, 100, 4) == [25, 50, 75]
    assert scan.strides(5, 5, 4) == [] and scan.strides(None, None, 4) == []
    day = lambda d, h=0: datetime.datetime(2024, 1, d, h)
    assert scan.strides(day(1), day(3), 4) == [day(1, 12), day(2), day(2, 12)]
    assert scan.strides(datetime.date(2024, 1, 1), datetime.date(2024, 1, 2), 4) == []
    assert scan.strides(0.0, 1.0, 2) == [0.5]


def test_refusals():
    for row, message in (({"partitions": 3}, "partition column"), ({"partitions": -1}, "positive")):
        with pytest.raises(SpecError, match=message):
            TableSpec.from_config({**TABLE, **row})
    with pytest.raises(SpecError, match="one partition"):
        TableSpec(output_table="q", query="SELECT 1", partition_column="id")
