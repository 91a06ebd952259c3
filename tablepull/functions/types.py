"""Source types: length, base type, relation kind, default value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Base type of each source type, and the word for each relation kind.
BASE_TYPES = {
    "smallint": "INTEGER",
    "integer": "INTEGER",
    "bigint": "INTEGER",
    "numeric": "NUMERIC",
    "decimal": "NUMERIC",
    "real": "FLOAT",
    "double precision": "FLOAT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp without time zone": "TIMESTAMP",
    "timestamp with time zone": "TIMESTAMP",
}
DEFAULT_BASE_TYPE = "STRING"
KIND_WORDS = {
    "r": "table",
    "v": "view",
    "m": "materialized view",
    "f": "foreign table",
    "i": "index",
    "S": "sequence",
    "c": "composite type",
    "t": "toast table",
}
INCREMENT_BASE_TYPES = ("INTEGER", "NUMERIC", "FLOAT", "TIMESTAMP")
# A type name, its parameters in brackets (a length, or a precision and a scale, which may be negative),
# and words such as "without time zone"; nothing that marks an array.
TYPE_WITH_LENGTH = r"^([^()\[\]]+)\(([0-9]+(?:,-?[0-9]+)?)\)[^()\[\]]*$"
_CUT = "\u0000"
VARCHAR = "character varying"


def _lookup(words: dict[str, str], column: Column, otherwise: str) -> Column:
    pairs = [F.lit(item) for pair in words.items() for item in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), column), F.lit(otherwise))


def split_type(column: Column) -> tuple[Column, Column]:
    """Type and length of ``numeric(10,2)``; an array type is kept whole, without length."""
    parts = type_parts(column)
    return parts[0], F.get(parts, F.lit(1))


def type_parts(column: Column) -> Column:
    """[type, length], or [type] if it has no length, by one match."""
    return F.split(F.regexp_replace(column, TYPE_WITH_LENGTH, f"$1{_CUT}$2"), _CUT)


def base_type(type_name: Column) -> Column:
    """Base type of a source type whose length has been split off."""
    return _lookup(BASE_TYPES, F.lower(type_name), DEFAULT_BASE_TYPE)


def decode_kind(code: Column) -> Column:
    """Word for a relation kind; empty for a kind that has none."""
    return _lookup(KIND_WORDS, code, "")


def clean_default(type_name: Column, expression: Column) -> Column:
    """Default value: the bare text for varchar columns, else the expression as written.

    Empty text and ``0`` count as no default.
    """
    bare = F.replace(F.substring_index(expression, "::", 1), F.lit("'"), F.lit(""))
    value = F.when(type_name == VARCHAR, bare).otherwise(expression)
    return F.when(~value.isin("", "0"), value)


def source_type(data_type: T.DataType) -> str:
    """Source type name, with length, of a Spark type."""
    if isinstance(data_type, T.DecimalType):
        return f"numeric({data_type.precision},{data_type.scale})"
    if isinstance(data_type, (T.VarcharType, T.CharType)):
        return f"character varying({data_type.length})"
    # Names of the types without parameters.
    names = {
        "byte": "smallint",
        "short": "smallint",
        "integer": "integer",
        "long": "bigint",
        "float": "real",
        "double": "double precision",
        "boolean": "boolean",
        "date": "date",
        "timestamp": "timestamp with time zone",
        "timestamp_ntz": "timestamp without time zone",
        "binary": "bytea",
    }
    return names.get(data_type.typeName(), "text")


def base_type_of(data_type: T.DataType) -> str:
    return BASE_TYPES.get(source_type(data_type).split("(")[0], DEFAULT_BASE_TYPE)
