"""Vectors as whole numbers: what the exact operators on embeddings compute with."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepull.functions.names import qcol


def usable(v: Column) -> Column:
    """Whether an ``array<double>`` is neither null nor empty and holds neither null nor non-finite components."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite, F.lit(False))


def whole(v: Column, scale: int) -> Column:
    """Each component x of an ``array<double>`` as floor(scale * x)."""
    return F.transform(v, lambda x: F.floor(x * F.lit(float(scale))))


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int, *others: Column) -> DataFrame:
    """(id, ``others``, q) of the rows whose vector can be used; q is ``array<long>``."""
    rows = vectors.select(qcol(id_col).cast("long").alias("id"), *others, qcol(vector_col).cast("array<double>").alias("v"))
    return rows.where(usable(F.col("v"))).withColumn("q", whole(F.col("v"), scale)).drop("v")


def largest(rows: DataFrame) -> int:
    """The largest absolute component of the column q; 0 without rows."""
    found = rows.agg(F.max(F.array_max("q")).alias("high"), F.min(F.array_min("q")).alias("low")).first()
    return 0 if found["high"] is None else max(abs(found["high"]), abs(found["low"]))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The rows of a column of equally long lists as a matrix of whole numbers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)
