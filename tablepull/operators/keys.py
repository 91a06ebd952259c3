"""Keys: one row each, and whether they really are keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablepull.functions.names import qcol
from tablepull.spec import SpecError


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key.

    ``row_number() = 1`` is evaluated per task before the shuffle too, so a key that
    many rows share sends one row per task.
    """
    window = Window.partitionBy(*[qcol(name) for name in keys]).orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(window))
    return ranked.filter("__rank = 1").drop("__rank")


def check_keys(df: DataFrame, keys: Sequence[str]) -> None:
    if not keys:
        raise SpecError("A primary key is required.")
    for name in keys:
        if name not in df.columns:
            raise SpecError(f'Primary key column "{name}" was not found.')


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or hold a NULL, with their number of rows."""
    check_keys(df, keys)
    incomplete = F.lit(False)
    for name in keys:
        incomplete = incomplete | qcol(name).isNull()
    counts = df.groupBy(*[qcol(name) for name in keys]).agg(F.count(F.lit(1)).alias("rows"))
    return counts.filter((F.col("rows") > 1) | incomplete)
