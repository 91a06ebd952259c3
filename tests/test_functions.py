import datetime
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablepull import SpecError, TableSpec
from tablepull.functions.names import project, qcol, quoted, sanitize_columns, sanitize_name, sanitize_names, sanitized
from tablepull.functions.render import render_bool, render_text
from tablepull.functions.types import base_type, base_type_of, clean_default, decode_kind, split_type
from tablepull.spec import specs_from_config


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [row[0] for row in df.select(expression(F.col("v"))).collect()]


# Names


def test_sanitized_names():
    assert sanitize_name("_Weir%d I-D") == "Weir_d_I_D"
    assert sanitize_name("auto Increment Timestamp") == "auto_Increment_Timestamp"
    assert sanitize_name("plain") == "plain"


def test_sanitized_data_follows_the_same_rule(spark):
    names = ["_Weir%d I-D", "auto Increment Timestamp", "a--b", "__x__", "é1"]
    assert column(spark, names, "string", sanitized) == [sanitize_name(n) for n in names]


def test_names_that_collide_are_refused():
    with pytest.raises(SpecError, match="a b.*a-b"):
        sanitize_names(["a b", "a-b"])
    with pytest.raises(SpecError):
        sanitize_names(["Ab", "aB"])
    with pytest.raises(SpecError):
        sanitize_names(["%%"])


def test_any_name_can_be_selected(spark):
    names = ["a.b", "a`b", "_Weir%d I-D", "select"]
    df = spark.createDataFrame([(1, 2, 3, 4)], ["c1", "c2", "c3", "c4"]).toDF(*names)
    assert [df.select(qcol(n)).first()[0] for n in names] == [1, 2, 3, 4]
    assert quoted("a`b") == "`a``b`"
    assert project(df, ["select", "a.b"]).columns == ["select", "a.b"]
    assert project(df).columns == names
    with pytest.raises(SpecError):
        project(df, ["nope"])
    assert sanitize_columns(df.select("`a.b`", "`_Weir%d I-D`")).columns == ["a_b", "Weir_d_I_D"]


# Text


def test_types_table_text(types_table):
    rows = [tuple(r) for r in render_text(types_table).collect()]
    assert rows[0] == ("alpha", "7", "5.100", "f", "2020-02-28")
    assert rows[3] == ("delta", "41", "99.999", "t", "1999-12-31")


def test_bool_styles(spark):
    assert column(spark, [True, False, None], "boolean", render_bool) == ["t", "f", None]
    assert column(spark, [True, False, None], "boolean", lambda c: render_bool(c, "10")) == ["1", "0", None]


def text_of(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [row[0] for row in render_text(df).collect()]


def test_float_text(spark):
    cases = {
        0.0: "0", 1.0: "1", -1.5: "-1.5", 100.0: "100", 1e7: "10000000", 123456789.125: "123456789.125",
        1e14: "100000000000000", 999999999999999.0: "999999999999999", 1e15: "1e+15", 1.5e20: "1.5e+20",
        0.001: "0.001", 0.00025: "0.00025", 1e-4: "0.0001", 1e-5: "1e-05", 1.5e-7: "1.5e-07", 1e-300: "1e-300",
        1.7976931348623157e308: "1.7976931348623157e+308",
        float("inf"): "Infinity", float("-inf"): "-Infinity",
    }
    assert text_of(spark, list(cases), "double") == list(cases.values())
    assert text_of(spark, [float("nan"), None, -0.0], "double") == ["NaN", None, "-0"]
    assert text_of(spark, [100000.0, 1e6, -1234567.0, 2.5e7, 0.5], "float") == ["100000", "1e+06", "-1.234567e+06", "2.5e+07", "0.5"]


def test_float_text_reads_back(spark):
    values = [x * 10.0**e for x in (1.0, 1.1, 9.87654321, 123.456) for e in range(-20, 20)]
    assert [float(t) for t in text_of(spark, values, "double")] == values


def test_other_texts(spark):
    assert text_of(spark, [Decimal("1.10"), Decimal("0.00"), None], "decimal(10,2)") == ["1.10", "0.00", None]
    moments = [datetime.datetime(2021, 1, 5, 13, 43, 17), datetime.datetime(2021, 1, 5, 13, 43, 17, 120000)]
    assert text_of(spark, moments, "timestamp_ntz") == ["2021-01-05 13:43:17", "2021-01-05 13:43:17.12"]
    assert text_of(spark, [bytearray(b"\x00\xffA")], "binary") == ["\\x00ff41"]
    assert text_of(spark, [[1, None, 3]], "array<int>") == ["[1,null,3]"]
    zoned = spark.sql("SELECT TIMESTAMP'2021-01-05 13:43:17+00:00' AS v")
    assert render_text(zoned).first()[0] == "2021-01-05 13:43:17+00"


# Types


def test_split_type(spark):
    cases = {
        "character varying(55)": ("character varying", "55"),
        "numeric(10,2)": ("numeric", "10,2"),
        "text": ("text", None),
        "timestamp(3) without time zone": ("timestamp", "3"),
        "numeric(10,2)[]": ("numeric(10,2)[]", None),
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    name, length = split_type(F.col("t"))
    assert [tuple(r) for r in df.select(name, length).collect()] == list(cases.values())


def test_base_types(spark):
    names = ["integer", "bigint", "numeric", "double precision", "boolean", "date", "timestamp without time zone", "text", "numeric(10,2)[]"]
    expected = ["INTEGER", "INTEGER", "NUMERIC", "FLOAT", "BOOLEAN", "DATE", "TIMESTAMP", "STRING", "STRING"]
    assert column(spark, names, "string", base_type) == expected


def test_base_types_of_frames(types_table):
    kinds = [base_type_of(f.dataType) for f in types_table.schema.fields]
    assert kinds == ["STRING", "INTEGER", "NUMERIC", "BOOLEAN", "DATE"]


def test_relation_kinds(spark):
    kinds = {"r": "table", "v": "view", "m": "materialized view", "f": "foreign table", "i": "index", "S": "sequence", "c": "composite type", "t": "toast table", "p": ""}
    assert column(spark, list(kinds), "string", decode_kind) == list(kinds.values())


def test_defaults(spark):
    cases = [
        ("character varying", "'mario'::character varying", "mario"),
        ("character varying", "'it''s'::character varying", "its"),
        ("character varying", "''::character varying", None),
        ("integer", "nextval('user_id_seq'::regclass)", "nextval('user_id_seq'::regclass)"),
        ("integer", "42", "42"),
        ("integer", "0", None),
        ("boolean", "false", "false"),
        ("text", None, None),
    ]
    df = spark.createDataFrame(cases, "t string, e string, expected string")
    rows = df.select(clean_default(F.col("t"), F.col("e")).alias("got"), "expected").collect()
    assert [r["got"] for r in rows] == [r["expected"] for r in rows]


# Specs


ROW = {"outputTable": "out", "table": {"schema": "public", "tableName": "t"}}


def test_spec_forms():
    spec = TableSpec.from_config({**ROW, "columns": ["a", "b"], "primaryKey": ["a", ""], "incrementalFetchingLimit": 5})
    assert (spec.columns, spec.primary_key, spec.increment_limit, spec.enabled) == (("a", "b"), ("a",), None, True)
    specs = specs_from_config({"tables": [ROW, {"outputTable": "q", "query": "SELECT 1", "enabled": False}]})
    assert [(s.output_table, s.enabled) for s in specs] == [("out", True), ("q", False)]
    assert [s.output_table for s in specs_from_config({"outputTable": "q", "query": "SELECT 1"})] == ["q"]
    assert TableSpec.from_config({**ROW, "forceFallback": True}).bool_style == "10"
    assert TableSpec.from_config({**ROW, "forceFallback": True, "useConsistentFallbackBooleanStyle": True}).bool_style == "tf"


def test_contradictions_are_refused():
    with pytest.raises(SpecError):
        TableSpec(output_table="x")
    with pytest.raises(SpecError):
        TableSpec(output_table="x", query="SELECT 1", table="t")
    with pytest.raises(SpecError, match="not supported for queries"):
        TableSpec.from_config({"outputTable": "x", "query": "SELECT 1", "incrementalFetchingColumn": "id"})
    with pytest.raises(SpecError):
        TableSpec(output_table="x", table="t", columns=("a",), increment_column="b")
    with pytest.raises(SpecError):
        TableSpec.from_config({"outputTable": "x", "table": {"schema": "s"}})


@given(st.text(max_size=20))
def test_clean_names_are_stable(name):
    clean = sanitize_name(name)
    assert sanitize_name(clean) == clean and not clean.startswith("_") and not clean.endswith("_")
