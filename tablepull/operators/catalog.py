"""Listing the tables and columns of an estate from its system catalogue.

The catalogue is five frames. Their joins are equi joins on relation ids, left to
Catalyst and adaptive execution: small sides (schemas) are broadcast by their real size.
"""

from __future__ import annotations

from collections.abc import Container, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepull.functions.types import base_type, clean_default, decode_kind, source_type, split_type, type_parts
from tablepull.operators.keys import first_per_key
from tablepull.session import broadcast_if_small

# What a listing leaves out, and the kinds a listing without columns shows.
SYSTEM_SCHEMAS = ("information_schema", "pg_catalog")
SYSTEM_SCHEMA_PREFIXES = ("pg_toast", "pg_temp")
SEQUENCE_KIND = "S"
LISTED_KINDS = ("r", "t", "v", "m", "f", "p")

Pairs = Iterable[tuple[str, str]]


@dataclass(frozen=True)
class Catalog:
    """namespace(oid, nspname); relation(oid, relname, relkind, reltype, relnamespace);
    attribute(attrelid, attname, type_with_length, attnotnull, attnum, attisdropped);
    index(indrelid, indkey, indisprimary); attrdef(adrelid, adnum, expr)."""

    namespace: DataFrame
    relation: DataFrame
    attribute: DataFrame
    index: DataFrame
    attrdef: DataFrame


# The catalogue frames as queries to a PostgreSQL server.
SERVER_QUERIES = {
    "namespace": "SELECT oid::bigint AS oid, nspname::text AS nspname FROM pg_namespace",
    "relation": "SELECT oid::bigint AS oid, relname::text AS relname, relkind::text AS relkind, "
    "reltype::bigint AS reltype, relnamespace::bigint AS relnamespace FROM pg_class",
    "attribute": "SELECT attrelid::bigint AS attrelid, attname::text AS attname, "
    "format_type(atttypid, atttypmod) AS type_with_length, attnotnull, attnum::int AS attnum, attisdropped FROM pg_attribute",
    "index": "SELECT indrelid::bigint AS indrelid, string_to_array(indkey::text, ' ')::int[] AS indkey, indisprimary FROM pg_index",
    "attrdef": "SELECT adrelid::bigint AS adrelid, adnum::int AS adnum, pg_get_expr(adbin, adrelid) AS expr FROM pg_attrdef",
}


def catalog_from_server(spark: SparkSession, connection: Mapping[str, str]) -> Catalog:
    read = lambda query: spark.read.format("jdbc").options(**connection, query=query).load()
    return Catalog(**{name: read(query) for name, query in SERVER_QUERIES.items()})


def _user_schemas(namespace: DataFrame) -> DataFrame:
    name = F.col("nspname")
    keep = ~name.isin(*SYSTEM_SCHEMAS)
    for prefix in SYSTEM_SCHEMA_PREFIXES:
        keep = keep & ~name.startswith(prefix)
    return namespace.filter(keep).select(F.col("oid").alias("schema_oid"), name.alias("table_schema"))


def _only(df: DataFrame, only: Pairs | DataFrame | None, pairwise: bool) -> DataFrame:
    """Keeps the wanted tables: exact pairs, or any wanted name in any wanted schema."""
    if only is None:
        return df
    names = ["table_schema", "table_name"]
    if isinstance(only, DataFrame):
        wanted = only.select(*names).distinct()
        if pairwise:
            return df.join(wanted, names, "left_semi")
        # Few schemas hold many relations: a side that fits is copied, so that none is shuffled by schema.
        for name in names:
            df = df.join(broadcast_if_small(wanted.select(name).distinct()), name, "left_semi")
        return df
    pairs = list(only)
    if pairwise:
        is_pair = F.lit(False)
        for schema, table in pairs:
            is_pair = is_pair | ((F.col(names[0]) == schema) & (F.col(names[1]) == table))
        return df.filter(is_pair)
    return df.filter(F.col(names[1]).isin([t for _, t in pairs]) & F.col(names[0]).isin([s for s, _ in pairs]))


def _relations(catalog: Catalog, condition: Column, only: Pairs | DataFrame | None, pairwise: bool) -> DataFrame:
    relations = (
        catalog.relation.filter(condition)
        .join(_user_schemas(catalog.namespace), F.col("relnamespace") == F.col("schema_oid"))
        .select("oid", "table_schema", F.col("relname").alias("table_name"), F.col("relkind").alias("kind"))
    )
    return _only(relations, only, pairwise)


def list_tables(catalog: Catalog, only: Pairs | DataFrame | None = None, pairwise: bool = True, ordered: bool = True) -> DataFrame:
    """Tables without their columns; the attributes are not read."""
    tables = first_per_key(
        _relations(catalog, F.col("relkind").isin(*LISTED_KINDS), only, pairwise),
        ["table_schema", "table_name"],
        [F.col("oid")],
    ).select("table_schema", "table_name", decode_kind(F.col("kind")).alias("table_type"))
    return tables.orderBy("table_schema", "table_name") if ordered else tables


def pk_flags(attribute: DataFrame, index: DataFrame) -> DataFrame:
    """Attributes with a flag for membership in their table's primary key."""
    primary = index.filter(F.col("indisprimary"))
    member = (F.col("attrelid") == F.col("indrelid")) & F.array_contains("indkey", F.col("attnum"))
    flagged = attribute.join(primary, member, "left")
    return flagged.withColumn("primary_key", F.col("indrelid").isNotNull()).drop(*index.columns)


def with_defaults(attribute: DataFrame, attrdef: DataFrame) -> DataFrame:
    """Attributes with the expression of their default value, if they have one."""
    defaults = attrdef.select(
        F.col("adrelid").alias("attrelid"), F.col("adnum").alias("attnum"), F.col("expr").alias("default_expr")
    )
    return attribute.join(defaults, ["attrelid", "attnum"], "left")


def list_columns(catalog: Catalog, system: bool = False, only: Pairs | DataFrame | None = None, pairwise: bool = True, ordered: bool = True, dedup: bool = True) -> DataFrame:
    """Every column of every table, with its type, keys and default.

    Dropped columns, sequences, indexes and system schemas are left out, and system
    columns too unless asked for. Of rows that name the same column the first one counts.
    """
    attribute = catalog.attribute.filter(~F.col("attisdropped"))
    if not system:
        attribute = attribute.filter(F.col("attnum") > 0)
    relations = _relations(
        catalog, (F.col("reltype") != 0) & (F.col("relkind") != SEQUENCE_KIND), only, pairwise
    )
    # All three joins start from the relation id, so the attributes are shuffled by it once.
    joined = attribute.join(relations, F.col("attrelid") == F.col("oid"))
    described = with_defaults(pk_flags(joined, catalog.index), catalog.attrdef)
    if dedup:
        # One shuffle by table serves the texts, the choice of first rows, and any later
        # grouping or join by table. A table has at most 1,600 columns, so no part is hot.
        spread = described.repartitionByRange if ordered else described.repartition
        described = spread("table_schema", "table_name")
    # One pass over the type text serves all that depends on it.
    described = described.withColumn("type_parts", type_parts(F.col("type_with_length")))
    type_name, length = F.col("type_parts")[0], F.get("type_parts", F.lit(1))
    columns = described.select(
        "table_schema",
        "table_name",
        decode_kind(F.col("kind")).alias("table_type"),
        F.col("attname").alias("column_name"),
        type_name.alias("data_type"),
        length.alias("length"),
        base_type(type_name).alias("base_type"),
        (~F.col("attnotnull")).alias("nullable"),
        "primary_key",
        F.col("attnum").alias("ordinal_position"),
        clean_default(type_name, F.col("default_expr")).alias("default_value"),
    )
    if dedup:
        columns = first_column(columns)
    return columns.orderBy("table_schema", "table_name", "ordinal_position") if ordered else columns


def first_column(columns: DataFrame) -> DataFrame:
    """One row per (schema, table, column): the lowest position, then the other facts in turn."""
    key = ["table_schema", "table_name", "column_name"]
    facts = ["ordinal_position", "data_type", "length", "nullable", "primary_key", "default_value", "table_type"]
    return first_per_key(columns, key, [F.col(name).asc_nulls_last() for name in facts])


def nest_columns(columns: DataFrame, nested: tuple[str, ...] = ("column_name", "data_type", "primary_key")) -> DataFrame:
    """One row per table with the list of its columns in order.

    A list holds the columns of one table, of which a server allows at most 1,600. The
    first column says what kind of table it is.
    """
    entry = F.struct("ordinal_position", "column_name", "table_type", *[n for n in nested if n != "column_name"])
    groups = columns.groupBy("table_schema", "table_name").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    return groups.select(
        "table_schema",
        "table_name",
        F.col("entries")[0]["table_type"].alias("table_type"),
        F.transform("entries", lambda e: F.struct(*[e[name].alias(name) for name in nested])).alias("columns"),
    )


def listing_of(spark: SparkSession, tables: Mapping[tuple[str, str], DataFrame], nullable: Container[tuple[str, str]] = ()) -> DataFrame:
    """The listing of frames that no catalogue describes, from their schemas; ``nullable`` tables may hold NULL anywhere."""
    rows = []
    for (schema, table), df in tables.items():
        for position, field in enumerate(df.schema.fields, start=1):
            rows.append((schema, table, "table", field.name, source_type(field.dataType), field.nullable or (schema, table) in nullable, position))
    declared = spark.createDataFrame(
        rows,
        "table_schema string, table_name string, table_type string, column_name string, "
        "type_with_length string, nullable boolean, ordinal_position int",
    )
    type_name, length = split_type(F.col("type_with_length"))
    return declared.select(
        "table_schema",
        "table_name",
        "table_type",
        "column_name",
        type_name.alias("data_type"),
        length.alias("length"),
        base_type(type_name).alias("base_type"),
        "nullable",
        F.lit(False).alias("primary_key"),
        "ordinal_position",
        F.lit(None).cast("string").alias("default_value"),
    )
