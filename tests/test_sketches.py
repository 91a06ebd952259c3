"""Profiles merged from increments against profiles of the whole table."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tablepull.operators.profile import column_profile
from tablepull.operators.sketches import DISTINCT_ERROR, append_sketches, merged_sketches, profile_from_sketches
from tablepull.spec import SpecError

SAME = ["column_name", "rows", "nulls", "min_value", "max_value", "max_length"]


def test_merged_profiles_equal_one_over_all_rows(spark, types_table, tmp_path):
    rng, path = random.Random(0), str(tmp_path / "s")
    schema = "id long, `a b.c` string, v double, at timestamp_ntz, tags array<string>, ok boolean, none int"
    base = datetime.datetime(2024, 1, 1)
    rows = [(i, rng.choice(["x", "yy", "", None, "zzz"]), rng.choice([None, rng.gauss(0, 1)]), base + datetime.timedelta(minutes=rng.randrange(500)), [str(i % 3)], i % 2 == 0, None) for i in range(6000)]
    whole = spark.createDataFrame(rows, schema)
    for low, high in ((0, 100), (100, 100), (100, 4000), (4000, 6000)):
        append_sketches(whole.filter((F.col("id") >= low) & (F.col("id") < high)), path)
    got = profile_from_sketches(spark, path)
    assert [tuple(r) for r in got.select(*SAME).collect()] == [tuple(r) for r in column_profile(whole).select(*SAME).collect()]
    exact = {r["column_name"]: r["distinct_values"] for r in column_profile(whole).collect()}
    facts = {r["column_name"]: r for r in got.collect()}
    for name, row in facts.items():
        assert abs(row["distinct_values"] - exact[name]) <= max(1, 3 * DISTINCT_ERROR * exact[name])
    assert [abs(q / 6000 - s) < 0.03 for q, s in zip(facts["id"]["quantiles"], (0.25, 0.5, 0.75))] == [True] * 3
    assert facts["a b.c"]["quantiles"] is None and facts["none"]["quantiles"] is None and facts["none"]["frequent"] is None
    counts = {}
    for r in rows:
        counts[r[1]] = counts.get(r[1], 0) + 1
    assert {(f["value"], f["n"]) for f in facts["a b.c"]["frequent"]} == {(k, n) for k, n in counts.items() if k is not None}


def test_increments_of_all_types_and_empty_ones(spark, types_table, tmp_path):
    path = str(tmp_path / "s")
    append_sketches(types_table.limit(0), path)
    assert {r["rows"] for r in profile_from_sketches(spark, path).collect()} == {0}
    append_sketches(types_table, path)
    assert [tuple(r) for r in profile_from_sketches(spark, path).select(*SAME).collect()] == [tuple(r) for r in column_profile(types_table).select(*SAME).collect()]


def test_parts_of_a_store_without_rows(spark, types_table, tmp_path):
    path = str(tmp_path / "s")
    append_sketches(types_table, path)
    append_sketches(types_table, path)
    store = spark.read.parquet(path)
    merged = merged_sketches(store.unionByName(store.filter("rows < 0")).repartition(6))
    assert merged.first()["rows"] == 8


def test_different_columns_are_refused(spark, types_table, tmp_path):
    path = str(tmp_path / "s")
    append_sketches(types_table, path)
    append_sketches(types_table.drop("date").withColumnRenamed("integer", "other"), path)
    with pytest.raises(SpecError, match="different columns"):
        profile_from_sketches(spark, path)
