"""Canonical text of every value, as it appears in the exported files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepull.functions.names import qcol

# Boolean words per style, and the exponent from which a float is
# written in scientific form.
BOOL_WORDS = {"tf": ("t", "f"), "10": ("1", "0")}
SCIENTIFIC_FROM = {"double": 1e15, "float": 1e6}
SCIENTIFIC_BELOW = 1e-4


def render_bool(column: Column, style: str = "tf") -> Column:
    yes, no = BOOL_WORDS[style]
    return F.when(column, yes).when(~column, no)


def render_float(column: Column, kind: str = "double") -> Column:
    """Shortest text of a float: ``100000000``, ``0.0001``, ``1e+15``, ``1.5e-07``."""
    text = column.cast("string")
    mantissa = _without_fraction(F.substring_index(text, "E", 1))
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    size = F.abs(column)
    short = _without_fraction(text)
    if kind == "float":
        # Spark writes single floats without an exponent up to ten million.
        digits = F.regexp_replace(text, r"^(-?\d)(\d{6})\.(\d+)$", "$1.$2$3")
        millions = (size >= SCIENTIFIC_FROM[kind]) & (size < 1e7)
        short = F.when(millions, F.concat(_without_fraction(digits), F.lit("e+06"))).otherwise(short)
    return (
        F.when(~text.contains("E"), short)
        .when(
            (size >= SCIENTIFIC_BELOW) & (size < SCIENTIFIC_FROM[kind]),
            _without_fraction(text.try_cast("decimal(38,20)").cast("string")),
        )
        .otherwise(F.concat(mantissa, F.format_string("e%+03d", exponent)))
    )


def _without_fraction(text: Column) -> Column:
    """A decimal text without trailing zeros: ``1.50`` as ``1.5``, ``20.0`` as ``20``."""
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))


def render(column: Column, data_type: T.DataType, bool_style: str = "tf") -> Column:
    """The text of one column; NULL stays NULL."""
    if isinstance(data_type, T.StringType):
        return column
    if isinstance(data_type, T.BooleanType):
        return render_bool(column, bool_style)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return render_float(column, data_type.typeName())
    if isinstance(data_type, T.TimestampType):
        offset = F.regexp_replace(F.date_format(column, "xxx"), ":00$", "")
        return F.concat(column.cast("string"), offset)
    if isinstance(data_type, T.BinaryType):
        return F.concat(F.lit("\\x"), F.lower(F.hex(column)))
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(column)
    return column.cast("string")


def render_text(df: DataFrame, bool_style: str = "tf") -> DataFrame:
    """Every column as text, names and order unchanged."""
    return df.select(
        *[render(qcol(f.name), f.dataType, bool_style).alias(f.name) for f in df.schema.fields]
    )
