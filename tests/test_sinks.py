import csv
import glob
import io

import pytest
from pyspark.sql import functions as F

from tablepull import SpecError, TableSpec
from tablepull.operators.catalog import listing_of
from tablepull.operators.keys import key_violations
from tablepull.operators.load import load, load_spec, mode_of, upserted
from tablepull.operators.profile import column_profile, column_profile_approx
from tablepull.operators.sinks import check_arity, read_csv, read_document, write_csv
from tablepull.plans.run import export_table, result_frame, run_job, run_specs
from tablepull.session import broadcast_if_small
from tablepull.sources.scan import parquet_tables
from tablepull.streaming.ingest import ingest_new, ingested

SF_DIR = "/root/testdata/sf0.001"


def text_of(path):
    files = sorted(glob.glob(f"{path}/part-*"))
    return "".join(open(name, newline="", encoding="utf-8").read() for name in files)


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


# CSV


def test_csv_bytes(spark, types_table, tmp_path):
    result = write_csv(types_table.orderBy("integer"), str(tmp_path / "types"), "integer", single_file=True)
    assert (result.rows, result.last_value) == (4, "41")
    assert text_of(tmp_path / "types").splitlines()[:2] == [
        '"beta","-3","0.001","t","2020-02-29"',
        '"gamma","0","-12.500","f","2020-03-01"',
    ]


def test_csv_keeps_every_character(spark, escaping, tmp_path):
    path = str(tmp_path / "escaping")
    write_csv(escaping, path)
    assert rows_of(read_csv(spark, path, ["col1", "col2"])) == rows_of(escaping)
    # Another reader sees the same values; it has no word for NULL.
    other = list(csv.reader(io.StringIO(text_of(path), newline="")))
    assert sorted(map(tuple, other)) == sorted((r[0] or "", r[1] or "") for r in escaping.collect())
    assert '"quotes """" inside, and a comma"' in text_of(path)
    assert ',""\n' in text_of(path) and '"",\n' in text_of(path)


def test_leading_zeros_stay(spark, tmp_path):
    df = spark.createDataFrame([("00720", "", "1999-01-01 00:00:00"), ("code", "x", "made")], "z string, s string, c string")
    write_csv(df, str(tmp_path / "sales"))
    assert rows_of(read_csv(spark, str(tmp_path / "sales"), df.columns)) == rows_of(df)


def test_one_column_keeps_null_and_empty(spark, tmp_path):
    values = [(None,), ("",), ("x",), ('say "a"\n\n""',), ("",), (None,), ("\n",)]
    write_csv(spark.createDataFrame(values, "c string"), str(tmp_path / "one"))
    got = [r[0] for r in read_csv(spark, str(tmp_path / "one"), ["c"]).collect()]
    assert sorted(got, key=repr) == sorted((v[0] for v in values), key=repr)


def test_empty_result_leaves_no_files(spark, types_table, tmp_path):
    path = tmp_path / "none"
    result = write_csv(types_table.filter("integer < -9"), str(path), "integer")
    assert (result.rows, result.last_value, result.path) == (0, None, None)
    assert not path.exists()


def test_rows_per_file(spark, tmp_path):
    write_csv(spark.range(0, 1000, 1, 1), str(tmp_path / "many"), records_per_file=300)
    assert len(glob.glob(f"{tmp_path}/many/part-*")) == 4


def test_arity(spark, escaping, tmp_path):
    write_csv(escaping, str(tmp_path / "good"))
    facts = check_arity(spark, str(tmp_path / "good"), ["col1", "col2"]).agg(F.sum("records"), F.sum("bad_records")).first()
    assert tuple(facts) == (9, 0)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0").write_text('"a","b"\n"only one"\n"one","two","three"\n"c","d"\n,\n')
    facts = check_arity(spark, str(tmp_path / "bad"), ["col1", "col2"]).first()
    assert (facts["records"], facts["bad_records"], facts["blank_records"]) == (5, 2, 1)


# Loading


def test_modes():
    assert mode_of(False, ["id"]) == "replace"
    assert mode_of(True, ["id"]) == "upsert"
    assert mode_of(True, []) == "append"


@pytest.mark.parametrize("partition_by", [[], ["part"]])
def test_upsert_is_idempotent(spark, tmp_path, partition_by):
    path = str(tmp_path / "target")
    schema = "part string, id int, v string, at int"
    load(spark, spark.createDataFrame([("01", 1, "old", 0), ("01", 2, "old", 0), ("02", 3, "old", 0)], schema), path, "upsert", ["part", "id"], partition_by=partition_by)
    batch = spark.createDataFrame([("01", 2, "mid", 1), ("01", 2, "new", 2), ("03", 4, "new", 1)], schema)
    for _ in range(2):
        load(spark, batch, path, "upsert", ["part", "id"], [F.col("at").desc()], partition_by)
        rows = spark.read.schema(schema).parquet(path).select("part", "id", "v", "at")
        assert rows_of(rows) == [("01", 1, "old", 0), ("01", 2, "new", 2), ("02", 3, "old", 0), ("03", 4, "new", 1)]


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    path = str(tmp_path / "target")
    base = spark.createDataFrame([(1, 1, "a"), (2, 2, "a")], "part int, id int, v string")
    load(spark, base, path, "replace", partition_by=["part"])
    before = {name: glob.os.stat(name).st_mtime_ns for name in glob.glob(f"{path}/part=1/*.parquet")}
    load(spark, spark.createDataFrame([(2, 2, "b")], base.schema), path, "upsert", ["part", "id"], partition_by=["part"])
    assert {name: glob.os.stat(name).st_mtime_ns for name in glob.glob(f"{path}/part=1/*.parquet")} == before
    assert rows_of(spark.read.schema(base.schema).parquet(path).select(base.columns)) == [(1, 1, "a"), (2, 2, "b")]


def test_replace_and_append(spark, tmp_path):
    path = str(tmp_path / "target")
    load(spark, spark.range(3), path, "replace")
    load(spark, spark.range(2), path, "append")
    assert spark.read.parquet(path).count() == 5
    load(spark, spark.range(1), path, "replace")
    assert spark.read.parquet(path).count() == 1


def test_upsert_with_a_hot_key_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr("tablepull.operators.load.broadcast_if_small", lambda df, **_: df)
    target = spark.range(1000).select(F.col("id"), F.lit("old").alias("v"))
    batch = spark.range(3000).select((F.when(F.col("id") < 1500, 7).otherwise(F.col("id"))).cast("long").alias("id"), F.col("id").cast("string").alias("v"))
    rows = {r["id"]: r["v"] for r in upserted(target, batch, ["id"], [F.col("v").cast("int").desc()]).collect()}
    assert len(rows) == 1000 + 1500 and rows[7] == "1499" and rows[8] == "old" and rows[2999] == "2999"


def test_load_is_checked(spark, tmp_path):
    with pytest.raises(SpecError):
        load(spark, spark.range(1), str(tmp_path), "merge")
    with pytest.raises(SpecError):
        load(spark, spark.range(1), str(tmp_path), "upsert")
    with pytest.raises(SpecError):
        load(spark, spark.range(1), str(tmp_path), "upsert", ["nope"])
    with pytest.raises(SpecError):
        load(spark, spark.range(1).withColumn("p", F.lit(1)), str(tmp_path), "upsert", ["id"], partition_by=["p"])


def test_broadcast_only_what_is_small(spark):
    df = spark.range(1000)
    assert "ResolvedHint (strategy=broadcast)" in broadcast_if_small(df)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in broadcast_if_small(df, limit=1000)._jdf.queryExecution().analyzed().toString()


def test_key_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (2, None)], "a int, b int")
    assert rows_of(key_violations(df, ["a", "b"])) == sorted([(1, 1, 2), (None, 3, 1), (2, None, 1)], key=str)


def test_profile_of_long_texts(spark):
    texts = ["x" * 64, "x" * 65, "x" * 65, "y" * 1000, "y" * 1000 + "z", None]
    row = column_profile(spark.createDataFrame([(t,) for t in texts], "t string")).first()
    assert tuple(row) == ("t", 6, 1, 4, "x" * 64, "y" * 1000 + "z", 1001)


def test_profile_of_nested_values(spark):
    df = spark.createDataFrame([([1.5, 2.0], {"a": 1}), ([1.5], {"a": 1}), (None, None)], "e array<double>, m map<string,int>")
    expected = [("e", 3, 1, 2, "[1.5,2.0]", "[1.5]", 9), ("m", 3, 1, 1, '{"a":1}', '{"a":1}', 7)]
    assert rows_of(column_profile(df)) == expected
    assert rows_of(column_profile_approx(df)) == expected


def test_upsert_of_maps(spark):
    row = lambda i: spark.range(1).select("id", F.create_map(F.lit("a"), F.lit(i)).alias("m"))
    assert rows_of(upserted(row(1), row(2).unionAll(row(2)), ["id"])) == [(0, {"a": 2})]


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "ccc", None), (None, "", 2.5)], "i int, s string, d double")
    expected = [("i", 3, 1, 1, "1", "1", None), ("s", 3, 0, 3, "", "ccc", 3), ("d", 3, 2, 1, "2.5", "2.5", None)]
    assert rows_of(column_profile(df)) == sorted(expected, key=str)
    assert rows_of(column_profile_approx(df)) == sorted(expected, key=str)
    empty = [(name, 0, 0, 0, None, None, None) for name in df.columns]
    assert rows_of(column_profile(df.filter("false"))) == sorted(empty, key=str)


# Jobs


def test_run_with_state(spark, increments, tmp_path):
    spec = TableSpec("out", schema="public", table="t", increment_column="_Weir%d I-D", increment_limit=2, incremental=True, primary_key=("_Weir%d I-D",))
    state = {}
    seen = []
    for run in range(3):
        result = export_table(spark, spec, increments, str(tmp_path / str(run)), state)
        state = result.state
        seen.append((result.rows, state["lastFetchedRow"]))
    assert seen == [(2, "2"), (2, "3"), (2, "4")]
    assert (tmp_path / "0" / "out.state.json").exists()


def test_run_of_an_empty_increment(spark, increments, tmp_path):
    spec = TableSpec("out", schema="public", table="t", increment_column="datetime")
    result = run_specs(spark, [spec], lambda schema, table: increments.filter("false"), str(tmp_path))[0]
    assert result.rows == 0 and result.state == {}
    assert result.warning == 'Query result set is empty. Exported "0" rows to "out".'
    assert not (tmp_path / "out.csv").exists() and not (tmp_path / "out.state.json").exists()
    assert (tmp_path / "out.csv.manifest").exists()


def test_requests_are_checked_before_reading(spark, tmp_path):
    tables = parquet_tables(spark, SF_DIR)
    for wrong in (
        dict(columns=("nope",)),
        dict(primary_key=("nope",)),
        dict(increment_column="r_name"),
        dict(increment_column="fakeCol"),
    ):
        with pytest.raises(SpecError):
            run_specs(spark, [TableSpec("r", schema="main", table="region", **wrong)], tables, str(tmp_path))
    assert not list(tmp_path.iterdir())
    same = TableSpec("r", schema="main", table="region")
    with pytest.raises(SpecError):
        run_specs(spark, [same, same], tables, str(tmp_path))


def test_summary(spark, tmp_path):
    specs = [TableSpec("a", schema="main", table="nation"), TableSpec("b", query="SELECT 1 AS x;"), TableSpec("c", schema="main", table="region", enabled=False)]
    results = run_specs(spark, specs, parquet_tables(spark, SF_DIR), str(tmp_path))
    assert rows_of(result_frame(spark, results)) == [("a", 25, None, None), ("b", 1, None, None)]


# Streaming


def test_ingest_takes_each_file_once(spark, tmp_path):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    total = events.count()
    paths = [str(tmp_path / name) for name in ("in", "checkpoint", "out")]
    events.write.parquet(paths[0])

    def taken():
        ingest_new(spark, paths[0], events.schema, paths[1], paths[2], files_per_batch=1)
        return ingested(spark, paths[2], events.schema).count()

    assert taken() == total
    assert taken() == total
    events.write.mode("append").parquet(paths[0])
    assert taken() == 2 * total


def test_upsert_keeps_what_the_batch_does_not_name(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, a string, b int")
    load(spark, base, path, "replace")
    for partition_by in ([], ["k"]):
        with pytest.raises(SpecError, match='Column "b"'):
            load(spark, base.drop("b"), path, "upsert", ["k"], partition_by=partition_by)
    with pytest.raises(SpecError, match="bigint in the batch"):
        load(spark, base.withColumn("k", F.col("k").cast("long")), path, "append")
    with pytest.raises(SpecError, match="NULL in its key"):
        load(spark, spark.createDataFrame([(None, "x", 1), (None, "y", 2)], base.schema), path, "upsert", ["k"])
    assert rows_of(spark.read.parquet(path)) == rows_of(base)
    load(spark, spark.createDataFrame([(9, 2, "new"), (3, 4, "more")], "b int, k int, a string"), path, "upsert", ["k"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a", 1), (2, "new", 9), (4, "more", 3)]
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]


def test_frame_upsert_counts_null_keys_as_equal(spark):
    target = spark.createDataFrame([(None, "old"), (1, "one")], "k int, v string")
    batch = spark.createDataFrame([(None, "new")], target.schema)
    once = upserted(target, batch, ["k"])
    assert upserted(once, batch, ["k"]).count() == 2 and {r["v"] for r in once.collect()} == {"new", "one"}


def test_a_job_that_cannot_be_described_leaves_nothing(spark, types_table, tmp_path):
    listing = listing_of(spark, {("public", "other"): types_table})
    spec = TableSpec("types", schema="public", table="types", increment_column="integer")
    with pytest.raises(SpecError, match="was not found in the catalogue"):
        run_specs(spark, [spec], lambda schema, table: types_table, str(tmp_path), listing=listing)
    assert list(tmp_path.iterdir()) == []


def test_job_options(spark, tmp_path):
    table = lambda session: lambda schema, name: session.range(3).select("id", F.current_timezone().alias("zone"))
    row = {"outputTable": "t", "table": {"schema": "s", "tableName": "t"}, "batchSize": 500, "incremental": True}
    job = {"tables": [row], "db": {"initQueries": ["SET TIME ZONE 'Asia/Manila'"]}, "dataTypeSupport": "authoritative"}
    run_job(spark, job, table, str(tmp_path))
    assert {r["zone"] for r in read_csv(spark, str(tmp_path / "t.csv"), ["id", "zone"]).collect()} == {"Asia/Manila"}
    assert "schema" in read_document(spark, str(tmp_path / "t.csv.manifest"))
    for _ in range(2):
        load_spec(spark, TableSpec.from_config(row), spark.range(3), str(tmp_path / "loaded"))
    assert spark.read.parquet(str(tmp_path / "loaded")).count() == 6
