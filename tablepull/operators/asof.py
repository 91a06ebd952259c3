"""As-of join: to every row the last row of another table at or before it, by key.

Both tables are merged in the order of (key, time) and cut into parts of about equal size, so a
key of any size is spread over many parts. Inside a part a window carries the last right row on.
What a part cannot see is the last right row of the parts before it: the few
(part, key) pairs of keys that cross a border get it from a small table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablepull.functions.names import qcol
from tablepull.functions.rows import comparable
from tablepull.session import broadcast_if_small, shared_dir
from tablepull.spec import SpecError

# Rows of both tables that make a part.
PART_ROWS = 1_000_000


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, columns: dict[str, str],
    strict: bool = False, tie_break: Sequence[Column] = (), part_rows: int = PART_ROWS,
) -> DataFrame:
    """The rows of ``left`` with some columns of the last row of ``right`` that has their keys and is not later.

    ``columns`` maps columns of ``right`` to their names in the result; they are NULL where there
    is no such row. ``strict`` asks for an earlier row. Among right rows of one time the last by ``tie_break``,
    then by all its columns, counts. NULL keys and NULL times match nothing. Every left row comes
    back once, repeated ones as often as they occur. Key and time columns need equal types on both sides.
    """
    for name, table in [*((k, t) for k in keys for t in (left, right)), (left_time, left), (right_time, right), *((c, right) for c in columns)]:
        if name not in table.columns:
            raise SpecError(f'Column "{name}" was not found in the table.')
    clash = [name for name in columns.values() if name in left.columns]
    if clash:
        raise SpecError(f'Column "{clash[0]}" is in the left table already.')
    spark, place = left.sparkSession, [f"__key{i}" for i in range(len(keys))]
    kind = {f.name: f.dataType for f in right.schema.fields}
    own = F.struct(*[qcol(name) for name in left.columns])
    brought = F.struct(*[qcol(source).alias(f"c{i}") for i, source in enumerate(columns)])
    named = lambda: [qcol(name).alias(at) for name, at in zip(keys, place)]
    known = reduce(and_, [qcol(name).isNotNull() for name in [*keys, right_time]])
    # Of rows of one time the right ones come first, unless only earlier ones count.
    ranked = F.struct(*[c.alias(f"t{i}") for i, c in enumerate([*tie_break, *comparable(right)])])
    rows = right.filter(known).select(*named(), qcol(right_time).alias("__time"), F.lit(1 if strict else -1).alias("__side"), ranked.alias("__tie"), brought.alias("__right"))
    spread = F.xxhash64(*comparable(left))
    asking = left.select(*named(), qcol(left_time).alias("__time"), F.lit(0).alias("__side"), own.alias("__left"), spread.alias("__spread"))
    merged = asking.unionByName(rows, allowMissingColumns=True)
    order = [F.col("__time"), F.col("__side"), F.col("__tie")]
    parts = max(1, -(-merged.count() // part_rows))
    staged = shared_dir(spark, "asof")
    # The part of a row is written with it, so that all that follows sees the same borders.
    merged.repartitionByRange(parts, *place, *order, "__spread").withColumn("__part", F.spark_partition_id()).write.parquet(staged)
    merged = spark.read.parquet(staged)

    inside = Window.partitionBy("__part", *place).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = merged.withColumn("__seen", F.last("__right", ignorenulls=True).over(inside)).filter(F.col("__left").isNotNull())
    if parts > 1:
        filled = _carried(merged, filled, place)
    back = [F.col("__left").getField(name).alias(name) for name in left.columns]
    return filled.select(*back, *[F.col("__seen").getField(f"c{i}").cast(kind[source]).alias(name) for i, (source, name) in enumerate(columns.items())])


def _carried(merged: DataFrame, filled: DataFrame, place: list[str]) -> DataFrame:
    """``filled`` with the last right row of the parts before, where a key began there."""
    # The last right row of each part and key: the largest by time and tie.
    latest = F.max_by("__right", F.when(F.col("__right").isNotNull(), F.struct("__time", "__side", "__tie")))
    ends = merged.groupBy(*place, "__part").agg(latest.alias("__last"))
    # A border lies in one key: at most two parts by border are left here, whatever the number of keys.
    crossing = ends.groupBy(*place).agg(F.min("__part").alias("__from"), F.max("__part").alias("__to")).filter("`__from` < `__to`")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"{k}_c")) for k in place])
    crossing = crossing.select(*[F.col(k).alias(f"{k}_c") for k in place])
    ends = ends.join(broadcast_if_small(crossing), same, "left_semi")
    before = Window.partitionBy(*place).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.withColumn("__before", F.last("__last", ignorenulls=True).over(before)).filter(F.col("__before").isNotNull())
    carry = carry.select(*[F.col(k).alias(f"{k}_c") for k in place], F.col("__part").alias("__part_c"), "__before")
    met = filled.join(carry, (F.col("__part") == F.col("__part_c")) & reduce(and_, [F.col(k) == F.col(f"{k}_c") for k in place]), "left")
    return met.withColumn("__seen", F.coalesce("__seen", "__before"))
