"""Column profiles that grow by increments: sketches are stored per increment and merged, the table is not read again.

An increment leaves one row: counts, extremes and text lengths as they are, distinct values as a
HyperLogLog sketch, quantiles of numbers as a KLL sketch, frequent values as a frequent-items
sketch. Each of them merges with the same result as one over all rows, within the stated errors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepull.functions.names import qcol, quoted
from tablepull.functions.render import render
from tablepull.operators.profile import measured
from tablepull.spec import SpecError

# Relative standard error of distinct counts; the largest error of a rank, as a share of the rows (with 99 % certainty).
DISTINCT_ERROR, RANK_ERROR = 0.017, 0.0133
_HLL_BITS = 12
# Values tracked for frequent ones: a count can be too low by 1 / (0.75 * this) of the rows at most.
TRACKED = 1024
FREQUENT_ERROR = 1 / (0.75 * TRACKED)


def _numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def sketch(df: DataFrame) -> DataFrame:
    """One row that holds all a profile of ``df`` needs, in one pass and without a shuffle of values."""
    facts = [F.count(F.lit(1)).alias("rows"), F.lit([f.name for f in df.schema.fields]).alias("names") if df.columns else F.array().alias("names")]
    plain = df.select(*[measured(f)[0].alias(f"v{i}") for i, f in enumerate(df.schema.fields)])
    for i, field in enumerate(df.schema.fields):
        value, kind = F.col(f"v{i}"), measured(field)[1]
        facts += [
            F.count(value).alias(f"filled_{i}"),
            F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)), _HLL_BITS).alias(f"distinct_{i}"),
            F.min(value).alias(f"lowest_{i}"),
            F.max(value).alias(f"highest_{i}"),
            (F.max(F.length(value)) if isinstance(kind, T.StringType) else F.max(F.lit(None))).cast("int").alias(f"length_{i}"),
            F.expr(f"approx_top_k_accumulate(coalesce(string(v{i}), ''), {TRACKED}) FILTER (WHERE v{i} IS NOT NULL)").alias(f"frequent_{i}"),
        ]
        if _numeric(kind):
            facts.append(F.kll_sketch_agg_double(value.cast("double")).alias(f"ranks_{i}"))
    return plain.agg(*facts)


def append_sketches(df: DataFrame, path: str) -> None:
    """Adds the sketches of an increment to a store; its columns must be those of the increments before."""
    sketch(df).write.mode("append").parquet(path)


def merged_sketches(store: DataFrame) -> DataFrame:
    """One row for all increments of a store."""
    names = store.select("names").distinct().limit(2).collect()
    if len(names) != 1:
        raise SpecError("The increments of the store have different columns." if names else "The store is empty.")
    facts = [F.sum("rows").alias("rows"), F.first("names").alias("names")]
    for i in range(len(names[0]["names"])):
        facts += [
            F.sum(f"filled_{i}").alias(f"filled_{i}"),
            F.hll_union_agg(f"distinct_{i}").alias(f"distinct_{i}"),
            F.min(f"lowest_{i}").alias(f"lowest_{i}"),
            F.max(f"highest_{i}").alias(f"highest_{i}"),
            F.max(f"length_{i}").alias(f"length_{i}"),
            F.expr(f"approx_top_k_combine(frequent_{i}, {TRACKED})").alias(f"frequent_{i}"),
        ]
        if f"ranks_{i}" in store.columns:
            facts.append(F.kll_merge_agg_double(f"ranks_{i}").alias(f"ranks_{i}"))
    # One row an increment, so one task merges them all; frequent items cannot be merged by a task without rows.
    return store.coalesce(1).agg(*facts)


def profile_from_sketches(spark: SparkSession, path: str, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75), frequent: int = 5) -> DataFrame:
    """The facts of ``column_profile_approx`` for all increments of a store, and beside them:

    ``quantiles`` of numbers (NULL for other columns) and the ``frequent`` values with their counts, as
    text. Distinct counts, ranks and counts of frequent values are within ``DISTINCT_ERROR`` (standard
    error), ``RANK_ERROR`` and ``FREQUENT_ERROR``. Rows that an upsert replaced count for every increment that
    brought them.
    """
    merged = merged_sketches(spark.read.parquet(path))
    names = merged.first()["names"]
    rows = [_column(merged, i, name, quantiles, frequent) for i, name in enumerate(names)]
    return merged.select(F.inline(F.array(*rows)))


def _column(merged: DataFrame, i: int, name: str, quantiles: tuple[float, ...], frequent: int) -> Column:
    kind = next(f.dataType for f in merged.schema.fields if f.name == f"lowest_{i}")
    some = F.col(f"filled_{i}") > 0
    ranks = F.lit(None).cast("array<double>")
    if f"ranks_{i}" in merged.columns:
        ranks = F.when(some, F.array(*[F.kll_sketch_get_quantile_double(f"ranks_{i}", F.lit(float(q))) for q in quantiles]))
    items = F.expr(f"approx_top_k_estimate({quoted(f'frequent_{i}')}, {frequent})")
    none = F.lit(None).cast("array<struct<value: string, n: bigint>>")
    return F.struct(
        F.lit(name).alias("column_name"),
        F.col("rows"),
        (F.col("rows") - F.col(f"filled_{i}")).alias("nulls"),
        F.hll_sketch_estimate(f"distinct_{i}").alias("distinct_values"),
        render(qcol(f"lowest_{i}"), kind).alias("min_value"),
        render(qcol(f"highest_{i}"), kind).alias("max_value"),
        F.col(f"length_{i}").alias("max_length"),
        ranks.alias("quantiles"),
        F.when(some, F.transform(items, lambda x: F.struct(x["item"].alias("value"), x["count"].cast("long").alias("n")))).otherwise(none).alias("frequent"),
    )
