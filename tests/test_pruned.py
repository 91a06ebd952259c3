"""Upserts that rewrite only the files that can hold a changed key, and streams of them."""

import os

import pytest
from pyspark.sql import functions as F

from tablepull.operators.bloom import bloom_blocks, block_of, blocks_for, key_hash, may_hold
from tablepull.operators.pruned import drop_versions, last_batch, latest_version, read_target, target_files, upsert_pruned
from tablepull.session import shared_dir
from tablepull.spec import SpecError
from tablepull.streaming.upsert import upsert_new

SCHEMA = "id long, name string, value int"


def rows(spark, ids, value=0):
    return spark.createDataFrame([(i, f"n{i}", value) for i in ids], SCHEMA)


def content(spark, path):
    return {(r["id"], r["value"]) for r in read_target(spark, path).collect()}


def test_untouched_files_keep_their_names(spark, tmp_path):
    path = str(tmp_path / "t")
    first = upsert_pruned(spark, rows(spark, range(0, 2000, 2)), path, ["id"], rows_per_file=100)
    before = target_files(spark, path)
    assert (first.version, first.replaced, len(before)) == (1, 0, 10)
    second = upsert_pruned(spark, rows(spark, range(300, 360), 7), path, ["id"], rows_per_file=100)
    after = target_files(spark, path)
    assert 1 <= second.replaced <= 2 and second.kept == 10 - second.replaced
    assert len(set(before) & set(after)) == second.kept
    assert content(spark, path) == {(i, 0) for i in range(0, 2000, 2) if not 300 <= i < 360} | {(i, 7) for i in range(300, 360)}
    # The version before is still whole.
    assert {r["id"] for r in read_target(spark, path, 1).collect()} == set(range(0, 2000, 2))


def test_filters_rule_out_files_whose_range_holds_the_keys(spark, tmp_path):
    """Odd keys lie in every range and in no filter: nothing is rewritten, but for false hits."""
    path = str(tmp_path / "t")
    upsert_pruned(spark, rows(spark, range(0, 2000, 2)), path, ["id"], rows_per_file=100)
    before = target_files(spark, path)
    done = upsert_pruned(spark, rows(spark, [151, 555, 1201], 1), path, ["id"])
    assert done.replaced <= 1 and len(set(before) & set(target_files(spark, path))) == done.kept >= 9
    assert len(content(spark, path)) == 1003


def test_last_row_wins_and_keys_of_several_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([("a", 1, 1), ("a", 1, 3), ("a", 2, 5), ("b", 1, 2)], "`my key` string, part int, v int")
    upsert_pruned(spark, batch, path, ["my key", "part"], [F.col("v").desc()], rows_per_file=1)
    again = spark.createDataFrame([(9, "a", 2), (8, "c", 0)], "v int, `my key` string, part int")
    upsert_pruned(spark, again, path, ["my key", "part"])
    assert sorted(map(tuple, read_target(spark, path).collect())) == [("a", 1, 3), ("a", 2, 9), ("b", 1, 2), ("c", 0, 8)]


def test_empty_batches_and_empty_targets(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_pruned(spark, rows(spark, []), path, ["id"])
    assert read_target(spark, path).columns == ["id", "name", "value"] and content(spark, path) == set()
    upsert_pruned(spark, rows(spark, [1]), path, ["id"])
    upsert_pruned(spark, rows(spark, []), path, ["id"])
    assert content(spark, path) == {(1, 0)} and latest_version(spark, path) == 3
    with pytest.raises(SpecError, match="no target"):
        read_target(spark, str(tmp_path / "none"))


def test_refusals(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_pruned(spark, rows(spark, [1, 2]), path, ["id"])
    with pytest.raises(SpecError, match="NULL"):
        upsert_pruned(spark, rows(spark, [3]).unionByName(spark.createDataFrame([(None, "x", 1)], SCHEMA)), path, ["id"])
    with pytest.raises(SpecError, match="not in both"):
        upsert_pruned(spark, rows(spark, [3]).drop("name"), path, ["id"])
    with pytest.raises(SpecError, match="not found"):
        upsert_pruned(spark, rows(spark, [3]), path, ["nope"])
    assert latest_version(spark, path) == 1 and len(content(spark, path)) == 2


def test_another_writer(spark, tmp_path, monkeypatch):
    """A version that appears meanwhile is not overwritten, and the upsert leaves no trace in the target."""
    from tablepull.operators import pruned

    path = str(tmp_path / "t")
    upsert_pruned(spark, rows(spark, [1]), path, ["id"])
    monkeypatch.setattr(pruned, "latest_version", lambda s, p: 1)
    upsert_pruned(spark, rows(spark, [2]), path, ["id"])
    with pytest.raises(SpecError, match="Another writer"):
        upsert_pruned(spark, rows(spark, [3]), path, ["id"])
    monkeypatch.undo()
    assert content(spark, path) == {(1, 0), (2, 0)}


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for value in range(3):
        upsert_pruned(spark, rows(spark, range(10), value), path, ["id"])
    assert len(os.listdir(tmp_path / "t" / "data")) == 3
    assert drop_versions(spark, path) == 2
    assert content(spark, path) == {(i, 2) for i in range(10)} and os.listdir(tmp_path / "t" / "_versions") == ["3"]


def test_a_delivery_counts_once(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_pruned(spark, rows(spark, [1], 1), path, ["id"], delivery=("s", 0))
    upsert_pruned(spark, rows(spark, [1], 2), path, ["id"], delivery=("s", 1))
    assert not upsert_pruned(spark, rows(spark, [1], 1), path, ["id"], delivery=("s", 0)).written
    assert upsert_pruned(spark, rows(spark, [2], 1), path, ["id"], delivery=("other", 0)).written
    assert content(spark, path) == {(1, 2), (2, 1)}
    assert (last_batch(spark, path, "s"), last_batch(spark, path, "other"), last_batch(spark, path, "none")) == (1, 0, None)


def test_a_stream_replays_a_batch(spark, tmp_path):
    """A batch whose commit the checkpoint lost runs again; its rows are in the target already."""
    base, path = str(tmp_path), str(tmp_path / "t")
    schema = rows(spark, []).schema
    for value, ids in ((1, [1, 2, 3]), (2, [3, 4])):
        rows(spark, ids, value).coalesce(1).write.mode("append").parquet(f"{base}/in")
        upsert_new(spark, f"{base}/in", schema, f"{base}/checkpoint", path, ["id"])
    want = {(1, 1), (2, 1), (3, 2), (4, 2)}
    assert content(spark, path) == want and latest_version(spark, path) == 2
    for name in os.listdir(tmp_path / "checkpoint" / "commits"):
        if name.strip(".").startswith("1"):
            os.remove(tmp_path / "checkpoint" / "commits" / name)
    upsert_new(spark, f"{base}/in", schema, f"{base}/checkpoint", path, ["id"])
    assert content(spark, path) == want and latest_version(spark, path) == 2
    rows(spark, [1, 5], 3).write.mode("append").parquet(f"{base}/in")
    upsert_new(spark, f"{base}/in", schema, f"{base}/checkpoint", path, ["id"])
    assert content(spark, path) == {(1, 3), (2, 1), (3, 2), (4, 2), (5, 3)}


def test_bloom_filter(spark):
    keys = spark.range(20_000).select(F.lit(1).alias("g"), key_hash(["id"]).alias("h"), blocks_for(F.lit(20_000)).alias("blocks"))
    filters = bloom_blocks(keys, ["g"], "h", "blocks")
    assert filters.count() == 8
    asked = spark.range(10_000, 40_000).select("id", key_hash(["id"]).alias("h")).withColumn("block", block_of(F.col("h"), F.lit(8)))
    hits = asked.join(filters, "block").filter(may_hold(F.col("bits"), F.col("h")))
    known, false = hits.filter("id < 20000").count(), hits.filter("id >= 20000").count()
    assert known == 10_000 and false < 0.02 * 20_000


def test_a_session_without_a_shared_folder(spark, monkeypatch):
    """Local sessions that name no folder get one, the same for all their tables."""
    real = type(spark.conf).get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *rest: None if key == "spark.checkpoint.dir" else real(self, key, *rest))
    one, two = shared_dir(spark, "a"), shared_dir(spark, "b")
    assert one != two and os.path.dirname(one) == os.path.dirname(two) and os.path.isdir(os.path.dirname(one))
    spark.range(3).write.parquet(one)
    assert spark.read.parquet(one).count() == 3
