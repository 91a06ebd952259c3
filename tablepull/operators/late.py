"""Value increments that also bring late rows: those that appear below a mark already passed.

A run reads again a stretch below its mark. The keys it sent from there are kept with the state, as
a table and as a Bloom filter of it. A row that the filter does not know is new for certain; one
it may know is settled by an anti-join with the table. A state is written aside and takes
effect by one rename, after the batch has been delivered.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepull.functions.names import qcol
from tablepull.functions.render import render
from tablepull.operators.bloom import block_of, blocks_for, bloom_blocks, key_hash, may_hold
from tablepull.operators.increment import bounded_increment, increment_type
from tablepull.operators.keys import check_keys
from tablepull.session import broadcast_if_small, child_names, path_exists, remove_path, rename_path, shared_dir
from tablepull.spec import SpecError


@dataclass(frozen=True)
class LateRun:
    """A batch, stored once, and the state that follows it; ``commit`` makes that state the current one."""

    batch: DataFrame
    mark: str | None
    state_path: str
    number: int
    aside: str | None

    def commit(self) -> None:
        if self.aside is None:
            return
        spark, target = self.batch.sparkSession, f"{self.state_path}/{self.number}"
        if path_exists(spark, target):
            raise SpecError(f"Another run wrote state {self.number} of {self.state_path}.")
        rename_path(spark, self.aside, target)
        remove_path(spark, f"{self.state_path}/{self.number - 1}")


def late_increment(df: DataFrame, column: str, keys: Sequence[str], state_path: str, overlap: str) -> LateRun:
    """The rows that are new since the last committed run, late ones included, and each key of them once.

    ``overlap`` says how far below the mark late rows are looked for: an interval such as "2
    days" for timestamps, a number else. A row below that is never found. A key counts as sent once a run
    brought it from the stretch that is read again, whatever its other columns say later; a row
    above the mark is always new. Without a state every row is new, those without a value too; later
    such rows are not found. Rows with a NULL key are told apart by the key they have.
    """
    check_keys(df, keys)
    spark, kind, path = df.sparkSession, increment_type(df, column), state_path.rstrip("/")
    number = max((int(n) for n in child_names(spark, path) if n.isdigit()), default=0)
    value = qcol(column)
    known = spark.read.parquet(f"{path}/{number}/mark").first() if number else None
    low = known["mark"] if known else None
    new = df if low is None else df.filter(value >= _below(low, kind, overlap))
    high = new.agg(render(F.max(value), kind).alias("high")).first()["high"]
    if high is None and low is not None:
        return LateRun(df.limit(0), low, path, number, None)
    if low is None:
        batch = bounded_increment(df, column, None, high)
    else:
        mark = F.lit(low).cast(kind)
        top = F.lit(high).cast(kind)
        fresh = df.filter((value > mark) & (value <= top))
        again = df.filter((value >= _below(low, kind, overlap)) & (value <= mark))
        batch = fresh.unionByName(_unseen(spark, again, keys, f"{path}/{number}", known["blocks"]))
    staged = shared_dir(spark, "late")
    batch.write.parquet(staged)
    batch = spark.read.schema(df.schema).parquet(staged)
    if high is None:
        return LateRun(batch, None, path, number, None)
    after = high if low is None else spark.range(1).select(render(F.greatest(F.lit(low).cast(kind), F.lit(high).cast(kind)), kind)).first()[0]
    aside = f"{path}/.{uuid.uuid4().hex}"
    _remember(spark, batch, column, kind, keys, after, overlap, f"{path}/{number}" if number else None, aside)
    return LateRun(batch, after, path, number + 1, aside)


def _below(mark: str, kind: T.DataType, overlap: str) -> Column:
    """The lower end of what is read again; a constant, so the filter reaches the scan."""
    at = F.lit(mark).cast(kind)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return (at - F.expr(f"INTERVAL {overlap}")).cast(kind)
    return (at - F.lit(overlap).cast(kind)).cast(kind)


def _same(keys: Sequence[str]) -> Column:
    return reduce(and_, [qcol(k).eqNullSafe(F.col(f"k{i}")) for i, k in enumerate(keys)])


def _unseen(spark: SparkSession, again: DataFrame, keys: Sequence[str], state: str, blocks: int) -> DataFrame:
    """The rows whose keys no run has sent: unknown to the filter, or known to it by chance only."""
    filters = spark.read.parquet(f"{state}/filter").withColumnRenamed("block", "__block")
    names = [qcol(name) for name in again.columns]
    asked = again.withColumn("__hash", key_hash(keys)).withColumn("__block", block_of(F.col("__hash"), F.lit(blocks)))
    asked = asked.join(broadcast_blocks(filters, blocks), "__block", "left")
    maybe = F.coalesce(may_hold(F.col("bits"), F.col("__hash")), F.lit(False))
    sent = spark.read.parquet(f"{state}/keys").select(*[f"k{i}" for i in range(len(keys))])
    settled = asked.filter(maybe).select(*names).join(broadcast_if_small(sent), _same(keys), "left_anti")
    return asked.filter(~maybe).select(*names).unionByName(settled)


def broadcast_blocks(filters: DataFrame, blocks: int) -> DataFrame:
    """A filter of a few thousand blocks of 4 KB is copied to the tasks; a larger one is joined by shuffle."""
    return F.broadcast(filters) if blocks <= 4096 else filters


def _remember(spark: SparkSession, batch: DataFrame, column: str, kind: T.DataType, keys: Sequence[str], mark: str, overlap: str, old: str | None, aside: str) -> None:
    """The next state: keys of the stretch that will be read again, their filter and the mark."""
    sent = batch.select(*[qcol(k).alias(f"k{i}") for i, k in enumerate(keys)], qcol(column).alias("value"))
    if old is not None:
        sent = spark.read.parquet(f"{old}/keys").unionByName(sent)
    sent.filter(F.col("value") >= _below(mark, kind, overlap)).write.parquet(f"{aside}/keys")
    kept = spark.read.parquet(f"{aside}/keys")
    size = kept.agg(blocks_for(F.count(F.lit(1))).alias("blocks")).first()["blocks"]
    hashed = kept.select(F.lit(0).alias("g"), key_hash([f"k{i}" for i in range(len(keys))]).alias("hash"), F.lit(size).alias("blocks"))
    bloom_blocks(hashed, ["g"], "hash", "blocks").select("block", "bits").write.parquet(f"{aside}/filter")
    spark.createDataFrame([(mark, size)], "mark string, blocks int").write.parquet(f"{aside}/mark")
