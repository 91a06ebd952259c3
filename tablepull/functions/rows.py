"""A fixed order for rows that nothing else orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepull.functions.names import qcol


def comparable(df: DataFrame) -> list[Column]:
    """The columns of ``df`` in a form that can be hashed and ordered: maps as JSON."""
    columns = []
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        columns.append(F.to_json(qcol(field.name)) if "map<" in kind or "variant" in kind else qcol(field.name))
    return columns


def row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*comparable(df))
