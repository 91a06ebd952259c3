"""Manifests: what an exported table is called, how it is loaded, what its columns are.

The input is a column listing (see ``catalog``) and a frame of targets with
(table_schema, table_name, destination, incremental, keys), where ``keys`` holds source
names. One manifest per table is built in Spark, so an estate is described in one job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepull.functions.names import sanitized
from tablepull.spec import TableSpec

TABLE = ["table_schema", "table_name"]


def targets_of(spark: SparkSession, specs: Iterable[TableSpec]) -> DataFrame:
    rows = [
        (spec.schema or "", spec.table or spec.output_table, spec.output_table, spec.incremental, list(spec.primary_key))
        for spec in specs
    ]
    return spark.createDataFrame(
        rows, "table_schema string, table_name string, destination string, incremental boolean, keys array<string>"
    )


def with_targets(listing: DataFrame, targets: DataFrame) -> DataFrame:
    """The listing with clean names. Key columns are those configured, and cannot be NULL."""
    by = [*TABLE, "destination"] if "destination" in listing.columns else TABLE
    joined = listing.drop("primary_key").join(targets, by)
    # Keys may be given by their source name or by their clean name.
    clean = sanitized(F.col("column_name"))
    is_key = F.array_contains("keys", F.col("column_name")) | F.array_contains("keys", clean)
    return (
        joined.withColumn("sanitized_name", clean)
        .withColumn("primary_key", is_key)
        .withColumn("nullable", F.col("nullable") & ~F.col("primary_key"))
    )


def _column_facts(query_form: bool) -> list[tuple[str, Column]]:
    facts = [
        ("datatype.nullable", F.col("nullable")),
        ("datatype.basetype", F.col("base_type")),
        ("datatype.default", F.col("default_value")),
        ("sourceName", F.col("column_name")),
        ("sanitizedName", F.col("sanitized_name")),
        ("uniqueKey", F.lit(False)),
        ("ordinalPosition", F.col("ordinal_position")),
    ]
    return [fact for fact in facts if not (query_form and fact[0] in ("datatype.default", "ordinalPosition"))]


def _table_facts() -> list[tuple[str, Column]]:
    return [
        ("name", F.col("table_name")),
        ("sanitizedName", sanitized(F.col("table_name"))),
        ("schema", F.col("table_schema")),
        ("type", F.when(F.col("table_type") != "", F.col("table_type"))),
    ]


def manifest_entries(listing: DataFrame, targets: DataFrame, query_form: bool = False, prefix: str = "") -> DataFrame:
    """The column facts as key/value rows, values as text; facts without a value are left out."""
    facts = F.array(
        *[
            F.struct(F.lit(prefix + key).alias("key"), value.cast("string").alias("value"))
            for key, value in _column_facts(query_form)
        ]
    )
    rows = with_targets(listing, targets).select(
        *TABLE, F.col("sanitized_name").alias("column_name"), F.inline(facts)
    )
    return rows.filter(F.col("value").isNotNull())


def _entries_json(facts: list[tuple[str, Column]], prefix: str) -> Column:
    """``[{"key":…,"value":…},…]`` with values of their own JSON type."""
    items = [
        F.when(value.isNotNull(), F.to_json(F.struct(F.lit(prefix + key).alias("key"), value.alias("value"))))
        for key, value in facts
    ]
    return F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))


def _object_json(members: list[tuple[str, Column]]) -> Column:
    """An object of members that are JSON already; a NULL member is left out."""
    items = [F.when(value.isNotNull(), F.concat(F.lit(f'"{key}":'), value)) for key, value in members]
    return F.concat(F.lit("{"), F.concat_ws(",", *items), F.lit("}"))


def _text_json(column: Column) -> Column:
    """``column`` as a JSON string."""
    listed = F.to_json(F.array(column))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def manifest_documents(listing: DataFrame, targets: DataFrame, typed: bool = False, query_form: bool = False, prefix: str = "") -> DataFrame:
    """One JSON manifest per table.

    The classic form lists key/value metadata per column; the typed form carries a schema.
    ``prefix`` goes before every metadata key. The manifest of a query has no table facts.
    """
    described = with_targets(listing, targets)
    if typed:
        return _typed(described, query_form, prefix)
    tables = _per_table(described, _entries_json(_column_facts(query_form), prefix))
    member = lambda e: F.concat(_text_json(e["name"]), F.lit(":"), e["body"])
    per_column = F.concat(F.lit("{"), F.concat_ws(",", F.transform("entries", member)), F.lit("}"))
    document = _object_json(
        [
            ("destination", _text_json(F.col("destination"))),
            ("incremental", F.col("incremental").cast("string")),
            *([] if query_form else [("metadata", _entries_json(_table_facts(), prefix))]),
            ("columns", F.to_json(F.transform("entries", lambda e: e["name"]))),
            ("primary_key", F.to_json(F.transform("keys", sanitized))),
            ("column_metadata", per_column),
        ]
    )
    return tables.select(*TABLE, "destination", document.alias("manifest"))


def _per_table(described: DataFrame, body: Column) -> DataFrame:
    """One row per table with its columns in export order; the first one tells the kind of table.

    A list holds the columns of one table, of which a server allows at most 1,600.
    """
    position = "export_position" if "export_position" in described.columns else "ordinal_position"
    entry = F.struct(position, "column_name", F.col("sanitized_name").alias("name"), "table_type", body.alias("body"))
    groups = described.groupBy(*TABLE, "destination", "incremental", "keys").agg(
        F.sort_array(F.collect_list(entry)).alias("entries")
    )
    return groups.withColumn("table_type", F.col("entries")[0]["table_type"])


def _typed(described: DataFrame, query_form: bool, prefix: str) -> DataFrame:
    names = {"sourceName", "sanitizedName", "uniqueKey", "ordinalPosition"}
    facts = [(prefix + key, value) for key, value in _column_facts(query_form) if key in names]
    column = F.struct(
        "nullable",
        "primary_key",
        F.struct(*[value.alias(key) for key, value in facts]).alias("metadata"),
        F.col("sanitized_name").alias("name"),
        F.struct(
            F.struct(
                (F.lit(None).cast("string") if query_form else F.col("default_value")).alias("default"),
                F.col("base_type").alias("type"),
            ).alias("base")
        ).alias("data_type"),
    )
    tables = _per_table(described, column)
    table_facts = F.struct(*[value.alias(prefix + key) for key, value in _table_facts()])
    document = F.struct(
        "destination",
        "incremental",
        *([] if query_form else [table_facts.alias("table_metadata")]),
        F.transform("entries", lambda e: e["body"]).alias("schema"),
    )
    return tables.select(*TABLE, "destination", F.to_json(document).alias("manifest"))


def typed_columns(listing: DataFrame, targets: DataFrame) -> DataFrame:
    """The schema of the typed form as rows, one per column."""
    return with_targets(listing, targets).select(
        *TABLE,
        "destination",
        F.col("sanitized_name").alias("name"),
        F.col("base_type").alias("type"),
        "length",
        F.col("default_value").alias("default"),
        "nullable",
        "primary_key",
        F.col("column_name").alias("source_name"),
        "ordinal_position",
    )
