"""Intermediate tables in the shared folder, and the components of a graph."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepull.session import remove_path, shared_dir

# Sides of a join up to this size are copied to every executor; larger ones are shuffled.
BROADCAST_BYTES = 32 * 1024 * 1024
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it has run, not when the driver next collects its garbage.

    For writes and counts, which are planned anew each time; a frame that is collected twice would shuffle twice.
    """
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, f"llm-{purpose}")
    with freed(spark):
        df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def drop_stored(*tables: DataFrame) -> None:
    """Removes tables of ``stored`` that nothing reads any more."""
    for table in tables:
        remove_path(table.sparkSession, table.stored_at)


def broadcast_below(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Marks ``df`` for broadcast if ``rows`` of ``row_bytes`` fit the bound."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def filtered(df: DataFrame, keep: Callable[[Iterator], Iterator]) -> DataFrame:
    """``df`` through a function that drops rows of its Arrow batches; columns may have any names."""
    plain = T.StructType([T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(df.schema.fields)])
    return df.toDF(*plain.names).mapInArrow(keep, plain).toDF(*df.columns)


def repeated(df: DataFrame, copies: str, number: str) -> DataFrame:
    """Every row as often as its column ``copies`` says, numbered from 0 in ``number``, without ``copies``."""
    some = 10_000
    step, rest = "repeat_step", F.col(copies) - F.col("repeat_step") * some
    df = df.withColumn(step, F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(`{copies}` - 1) div {some}"))))
    df = df.withColumn(number, F.explode(F.sequence(F.lit(1).cast("long"), F.least(rest, F.lit(some).cast("long")))))
    return df.withColumn(number, F.col(number) - 1 + F.col(step) * some).drop(copies, step)


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b): the smallest id that can be reached.

    Alternating stars: in each pass every id sends its larger neighbours to its smallest
    one, then its smaller neighbours likewise, until every id points at a root. Edges keep what they
    connect in every pass. They fold by their larger end before a shuffle; a hub of any size
    is only ever a minimum and a join key.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges"
    )

    def open_ids(table: DataFrame) -> DataFrame:
        """Ids that have two edges, or one while others point at them."""
        ends = table.select(F.col("u").alias("id"), F.lit(1).alias("edges"), F.lit(0).alias("ends"))
        ends = ends.union(table.select(F.col("v"), F.lit(0), F.lit(1)))
        return ends.groupBy("id").agg(F.sum("edges").alias("edges"), F.max("ends").alias("ends")).where("edges > 1 or (edges > 0 and ends > 0)")

    while not open_ids(now).isEmpty():
        # Large star: neighbours above u go to the smallest of u and its neighbours.
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u != v"), "edges")
        # Small star: neighbours below u, and u, go to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        after = stored(small.where("u != v").distinct(), "edges")
        drop_stored(now, large)
        now = after
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    out = stored(now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots), "components")
    drop_stored(now)
    return out
