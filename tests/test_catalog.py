import json
import time

import pytest
from pyspark.sql import functions as F

from tablepull import TableSpec
from tablepull.operators.catalog import Catalog, list_columns, list_tables, listing_of, nest_columns
from tablepull.operators.manifest import manifest_documents, manifest_entries, targets_of, typed_columns
from tablepull.operators.sinks import read_document
from tablepull.plans.run import describe, run_specs


def catalog_of(spark, namespace, relation, attribute, index, attrdef):
    return Catalog(
        spark.createDataFrame(namespace, "oid long, nspname string"),
        spark.createDataFrame(relation, "oid long, relname string, relkind string, reltype long, relnamespace long"),
        spark.createDataFrame(attribute, "attrelid long, attname string, type_with_length string, attnotnull boolean, attnum int, attisdropped boolean"),
        spark.createDataFrame(index, "indrelid long, indkey array<int>, indisprimary boolean"),
        spark.createDataFrame(attrdef, "adrelid long, adnum int, expr string"),
    )


@pytest.fixture(scope="module")
def catalog(spark):
    """Two user schemas with crossing table names, and everything a listing leaves out."""
    return catalog_of(
        spark,
        [(1, "public"), (2, "other"), (3, "pg_catalog"), (4, "information_schema"), (5, "pg_toast_1"), (6, "pg_temp_2")],
        [
            (10, "auto Increment", "r", 100, 1), (11, "t2", "v", 101, 1), (12, "t1", "p", 102, 2), (13, "t2", "r", 103, 2),
            (14, "t1", "r", 104, 1), (15, "user_id_seq", "S", 105, 1), (16, "t1_pkey", "i", 0, 1), (17, "pg_class", "r", 106, 3),
            (18, "columns", "v", 107, 4), (19, "chunk", "t", 108, 5), (20, "scratch", "r", 109, 6),
        ],
        [
            (10, "_Weir%d I-D", "integer", True, 1, False),
            (10, "Weir%d Na-me", "character varying(55)", True, 2, False),
            (10, "amount", "numeric(10,2)", False, 4, False),
            (10, "........pg.dropped.3", "-", False, 3, True),
            (10, "ctid", "tid", True, -1, False),
            (11, "id", "integer", False, 1, False),
            (12, "b", "text", False, 2, False), (12, "a", "date", True, 1, False),
            (13, "x", "boolean", False, 1, False),
            (14, "k", "bigint", True, 1, False), (14, "l", "timestamp without time zone", True, 2, False),
            (15, "last_value", "bigint", True, 1, False), (16, "k", "bigint", False, 1, False),
            (17, "oid", "oid", True, 1, False), (18, "c", "text", False, 1, False), (19, "c", "bytea", False, 1, False), (20, "c", "text", False, 1, False),
        ],
        [(10, [1], True), (10, [2], False), (14, [2, 1], True), (13, [1], False)],
        [(10, 1, "nextval('user_id_seq'::regclass)"), (10, 2, "'mario'::character varying"), (13, 1, "false"), (14, 1, "0")],
    )


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_tables(catalog):
    assert rows_of(list_tables(catalog)) == [
        ("other", "t1", ""), ("other", "t2", "table"), ("public", "auto Increment", "table"), ("public", "t1", "table"), ("public", "t2", "view"),
    ]


def test_columns(catalog):
    names = ["table_schema", "table_name", "column_name", "data_type", "length", "base_type", "nullable", "primary_key", "ordinal_position", "default_value"]
    assert rows_of(list_columns(catalog).select(*names)) == [
        ("other", "t1", "a", "date", None, "DATE", False, False, 1, None),
        ("other", "t1", "b", "text", None, "STRING", True, False, 2, None),
        ("other", "t2", "x", "boolean", None, "BOOLEAN", True, False, 1, "false"),
        ("public", "auto Increment", "_Weir%d I-D", "integer", None, "INTEGER", False, True, 1, "nextval('user_id_seq'::regclass)"),
        ("public", "auto Increment", "Weir%d Na-me", "character varying", "55", "STRING", False, False, 2, "mario"),
        ("public", "auto Increment", "amount", "numeric", "10,2", "NUMERIC", True, False, 4, None),
        ("public", "t1", "k", "bigint", None, "INTEGER", False, True, 1, None),
        ("public", "t1", "l", "timestamp without time zone", None, "TIMESTAMP", False, True, 2, None),
        ("public", "t2", "id", "integer", None, "INTEGER", True, False, 1, None),
    ]


def test_system_columns(catalog):
    system = list_columns(catalog, system=True).filter("ordinal_position < 0")
    assert [r["column_name"] for r in system.collect()] == ["ctid"]


def test_whitelist(spark, catalog):
    only = [("public", "t1"), ("other", "t2")]
    frame = spark.createDataFrame(only, "table_schema string, table_name string")
    pairs = {("other", "t2"), ("public", "t1")}
    crossed = pairs | {("other", "t1"), ("public", "t2")}
    for wanted in (only, frame):
        for listing in (list_tables, list_columns):
            found = lambda **how: {(r["table_schema"], r["table_name"]) for r in listing(catalog, only=wanted, **how).collect()}
            assert found() == pairs
            assert found(pairwise=False) == crossed


def test_first_row_of_a_column_counts(spark, catalog):
    twice = Catalog(catalog.namespace, catalog.relation, catalog.attribute.unionAll(catalog.attribute), catalog.index, catalog.attrdef)
    assert rows_of(list_columns(twice)) == rows_of(list_columns(catalog))


def test_nested(catalog):
    nested = {(r["table_schema"], r["table_name"]): [tuple(c) for c in r["columns"]] for r in nest_columns(list_columns(catalog)).collect()}
    assert nested[("other", "t1")] == [("a", "date", False), ("b", "text", False)]
    assert len(nested) == 5


def test_listing_300_tables_is_quick(spark):
    """Limit: 5 s for 300 tables of 21 columns."""
    tables = spark.range(300).select(F.col("id").alias("oid"), F.format_string("t_%04d", "id").alias("relname"), F.lit("r").alias("relkind"), (F.col("id") + 1).alias("reltype"), F.lit(1).cast("long").alias("relnamespace"))
    columns = tables.select("oid", F.explode(F.sequence(F.lit(1), F.lit(21))).alias("attnum")).select(
        F.col("oid").alias("attrelid"), F.when(F.col("attnum") == 1, "id").otherwise(F.format_string("%04d_c", F.col("attnum") - 2)).alias("attname"),
        F.when(F.col("attnum") == 1, "integer").otherwise("character varying(50)").alias("type_with_length"), (F.col("attnum") == 1).alias("attnotnull"), "attnum", F.lit(False).alias("attisdropped"))
    index = tables.select(F.col("oid").alias("indrelid"), F.array(F.lit(1)).alias("indkey"), F.lit(True).alias("indisprimary"))
    namespace = spark.createDataFrame([(1, "public")], "oid long, nspname string")
    attrdef = spark.createDataFrame([], "adrelid long, adnum int, expr string")
    catalog = Catalog(namespace, tables, columns, index, attrdef)
    list_columns(catalog).collect()  # starts the engine
    start = time.time()
    listed = list_columns(catalog).collect()
    assert len(listed) == 300 * 21 and sum(r["primary_key"] for r in listed) == 300
    assert time.time() - start < 5.0


# Manifests


def auto_listing(catalog):
    return list_columns(catalog).filter("table_name = 'auto Increment'")


def test_classic_manifest(spark, catalog):
    spec = TableSpec("out.auto", schema="public", table="auto Increment", incremental=True, primary_key=("_Weir%d I-D",))
    document = json.loads(manifest_documents(auto_listing(catalog), targets_of(spark, [spec]), prefix="x.").first()["manifest"])
    assert list(document) == ["destination", "incremental", "metadata", "columns", "primary_key", "column_metadata"]
    assert document["destination"] == "out.auto" and document["incremental"] is True
    assert document["metadata"] == [
        {"key": "x.name", "value": "auto Increment"}, {"key": "x.sanitizedName", "value": "auto_Increment"},
        {"key": "x.schema", "value": "public"}, {"key": "x.type", "value": "table"},
    ]
    assert document["columns"] == ["Weir_d_I_D", "Weir_d_Na_me", "amount"]
    assert document["primary_key"] == ["Weir_d_I_D"]
    assert document["column_metadata"]["Weir_d_I_D"] == [
        {"key": "x.datatype.nullable", "value": False}, {"key": "x.datatype.basetype", "value": "INTEGER"},
        {"key": "x.datatype.default", "value": "nextval('user_id_seq'::regclass)"},
        {"key": "x.sourceName", "value": "_Weir%d I-D"}, {"key": "x.sanitizedName", "value": "Weir_d_I_D"},
        {"key": "x.uniqueKey", "value": False}, {"key": "x.ordinalPosition", "value": 1},
    ]
    assert [e["key"] for e in document["column_metadata"]["amount"]][2] == "x.sourceName"


def test_typed_manifest(spark, catalog):
    spec = TableSpec("out", schema="public", table="auto Increment")
    document = json.loads(manifest_documents(auto_listing(catalog), targets_of(spark, [spec]), typed=True).first()["manifest"])
    assert list(document) == ["destination", "incremental", "table_metadata", "schema"]
    assert document["table_metadata"] == {"name": "auto Increment", "sanitizedName": "auto_Increment", "schema": "public", "type": "table"}
    # Keys of the source do not count; only configured ones do.
    assert document["schema"][0] == {
        "nullable": False, "primary_key": False,
        "metadata": {"sourceName": "_Weir%d I-D", "sanitizedName": "Weir_d_I_D", "uniqueKey": False, "ordinalPosition": 1},
        "name": "Weir_d_I_D",
        "data_type": {"base": {"default": "nextval('user_id_seq'::regclass)", "type": "INTEGER"}},
    }
    assert document["schema"][2]["data_type"] == {"base": {"type": "NUMERIC"}}
    assert typed_columns(auto_listing(catalog), targets_of(spark, [spec])).count() == 3


def test_query_manifest(spark, escaping):
    spec = TableSpec("out.escaping", query="SELECT * FROM escaping", primary_key=("col1",))
    document = json.loads(describe(spark, {spec: escaping})["out.escaping"])
    assert "metadata" not in document and document["primary_key"] == ["col1"]
    keys = ["datatype.nullable", "datatype.basetype", "sourceName", "sanitizedName", "uniqueKey"]
    assert [e["key"] for e in document["column_metadata"]["col1"]] == keys
    assert [document["column_metadata"][c][0]["value"] for c in ("col1", "col2")] == [False, True]


def test_manifest_entries_and_awkward_texts(spark):
    listing = listing_of(spark, {("s", 'a"b'): spark.createDataFrame([(1, "x")], ["id", 'q"\\uote'])})
    targets = targets_of(spark, [TableSpec("out", schema="s", table='a"b', primary_key=("id",))])
    document = json.loads(manifest_documents(listing, targets).first()["manifest"])
    assert document["metadata"][0]["value"] == 'a"b'
    assert document["column_metadata"]["q_uote"][2] == {"key": "sourceName", "value": 'q"\\uote'}
    entries = {(r["column_name"], r["key"]): r["value"] for r in manifest_entries(listing, targets).collect()}
    assert entries[("id", "datatype.nullable")] == "false" and ("id", "datatype.default") not in entries


def test_manifest_follows_the_exported_columns(spark, types_table, tmp_path):
    spec = TableSpec("types", schema="public", table="types", columns=("date", "character"), primary_key=("character",))
    run_specs(spark, [spec], lambda schema, table: types_table, str(tmp_path))
    document = read_document(spark, str(tmp_path / "types.csv.manifest"))
    assert document["columns"] == ["date", "character"] and list(document["column_metadata"]) == ["date", "character"]
    positions = {c: e[-1]["value"] for c, e in document["column_metadata"].items()}
    assert positions == {"date": 5, "character": 1}


def test_manifest_from_a_catalogue(spark, catalog, tmp_path):
    spec = TableSpec("auto", schema="public", table="auto Increment", columns=("amount", "_Weir%d I-D"))
    df = spark.createDataFrame([(1, "m", 1.5)], "`_Weir%d I-D` int, `Weir%d Na-me` string, amount double")
    run_specs(spark, [spec], lambda schema, table: df, str(tmp_path), listing=list_columns(catalog))
    document = read_document(spark, str(tmp_path / "auto.csv.manifest"))
    assert document["columns"] == ["amount", "Weir_d_I_D"]
    assert [e[-1]["value"] for e in document["column_metadata"].values()] == [4, 1]
