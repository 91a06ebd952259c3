"""Measured facts per column, to hold against the declared metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepull.functions.names import qcol
from tablepull.functions.render import render

# Relative standard error of estimated distinct counts.
APPROX_ERROR = 0.05


def column_profile(df: DataFrame) -> DataFrame:
    """Rows, NULLs, distinct values, smallest and largest value, longest text of each column.

    Every column is scanned by itself (a columnar file is read once in all) and its values
    are counted first. Repeated values are folded before the shuffle, and no row is
    multiplied as it would be by several distinct counts in one aggregation. Texts are
    counted by digest, so that none is shuffled, and scanned once more for their extremes.
    """
    return reduce(DataFrame.unionAll, [_profile(df, field) for field in df.schema.fields])


def measured(field: T.StructField) -> tuple[Column, T.DataType]:
    """A column and its type; arrays, maps and structs count as their JSON text."""
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(qcol(field.name)), T.StringType()
    return qcol(field.name), field.dataType


def _profile(df: DataFrame, field: T.StructField) -> DataFrame:
    column, data_type = measured(field)
    if isinstance(data_type, T.StringType):
        counted = _counts(df, F.sha2(column, 256), extremes=False)
        scanned = df.agg(
            F.min(column).alias("lowest"), F.max(column).alias("highest"), F.max(F.length(column)).alias("max_length")
        )
        both = counted.unionByName(scanned, allowMissingColumns=True)
        facts = both.agg(*[F.max(name).alias(name) for name in both.columns])
    else:
        facts = _counts(df, column, extremes=True).withColumn("max_length", F.lit(None).cast("int"))
    return facts.select(
        F.lit(field.name).alias("column_name"),
        "rows",
        "nulls",
        "distinct_values",
        render(F.col("lowest"), data_type).alias("min_value"),
        render(F.col("highest"), data_type).alias("max_value"),
        "max_length",
    )


def _counts(df: DataFrame, column: Column, extremes: bool) -> DataFrame:
    value, n = F.col("value"), F.col("n")
    counts = df.groupBy(column.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(value.isNull(), n)), F.lit(0)).alias("nulls"),
        F.count(value).alias("distinct_values"),
        *([F.min(value).alias("lowest"), F.max(value).alias("highest")] if extremes else []),
    )


def column_profile_approx(df: DataFrame, error: float = APPROX_ERROR) -> DataFrame:
    """The same facts in one pass without a shuffle of values; distinct counts within ``error``."""
    measures = [F.count(F.lit(1)).alias("rows")]
    for i, field in enumerate(df.schema.fields):
        column, data_type = measured(field)
        text = isinstance(data_type, T.StringType)
        measures += [
            F.count(column).alias(f"filled_{i}"),
            F.approx_count_distinct(column, error).alias(f"distinct_{i}"),
            F.min(column).alias(f"lowest_{i}"),
            F.max(column).alias(f"highest_{i}"),
            (F.max(F.length(column)) if text else F.max(F.lit(None))).cast("int").alias(f"length_{i}"),
        ]
    row = F.array(
        *[
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.col("rows"),
                (F.col("rows") - F.col(f"filled_{i}")).alias("nulls"),
                F.col(f"distinct_{i}").alias("distinct_values"),
                render(F.col(f"lowest_{i}"), measured(field)[1]).alias("min_value"),
                render(F.col(f"highest_{i}"), measured(field)[1]).alias("max_value"),
                F.col(f"length_{i}").alias("max_length"),
            )
            for i, field in enumerate(df.schema.fields)
        ]
    )
    return df.agg(*measures).select(F.inline(row))
