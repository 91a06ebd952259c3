"""How a batch enters its target: replace, append, or upsert by key."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepull.functions.names import qcol
from tablepull.functions.rows import row_hash
from tablepull.operators.keys import check_keys, first_per_key
from tablepull.session import broadcast_if_small, path_exists, remove_path, rename_path, shared_dir
from tablepull.spec import SpecError, TableSpec

MODES = ("replace", "append", "upsert")


def mode_of(incremental: bool, primary_key: Sequence[str]) -> str:
    if not incremental:
        return "replace"
    return "upsert" if primary_key else "append"


def replaced(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The batch in place of the target, in the target's column order."""
    return batch.select(*[qcol(name) for name in target.columns])


def appended(target: DataFrame, batch: DataFrame) -> DataFrame:
    return target.unionByName(batch)


def upserted(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), cluster_by: Sequence[str] = ()) -> DataFrame:
    """The target with the rows of the batch put in by key; the last row per key wins.

    ``order`` says which row of the batch is the last; a hash of the row only makes the
    choice repeatable. NULL keys count as equal. Keys are made distinct before the join, so a key the batch repeats
    often is one row there. A small key set is copied to the target's tasks and the
    target is not shuffled at all; a large one is joined by shuffle, where adaptive
    execution splits uneven parts. ``cluster_by`` gathers the batch's rows for a
    partitioned write; the target's rows come from their partitions already.
    """
    check_keys(target, keys)
    return _merged(target, latest_per_key(batch, keys, order), batch, keys, cluster_by)


def _merged(target: DataFrame, latest: DataFrame, changed: DataFrame, keys: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    """``target`` without the keys of ``changed``, and the rows of ``latest``."""
    if cluster_by:
        latest = latest.hint("rebalance", *cluster_by)
    names = [qcol(name).alias(f"__key{i}") for i, name in enumerate(keys)]
    changed = changed.select(*names)
    gone = broadcast_if_small(changed.distinct(), measured=changed)
    same = reduce(and_, [qcol(name).eqNullSafe(F.col(f"__key{i}")) for i, name in enumerate(keys)])
    return target.join(gone, same, "left_anti").unionByName(latest)


def latest_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    check_keys(batch, keys)
    return first_per_key(batch, keys, [*order, row_hash(batch)])


def load(spark: SparkSession, batch: DataFrame, path: str, mode: str, keys: Sequence[str] = (), order: Sequence[Column] = (), partition_by: Sequence[str] = ()) -> None:
    """Loads a batch into a Parquet target.

    Append and upsert need a batch with the columns and types of the target, in any order;
    an upsert refuses NULL in a key column. The latest rows of an upsert are staged in the
    shared folder once, so the batch is read once and cannot change on the way.

    An upsert into a partitioned target reads and rewrites only the partitions the batch
    touches; the partition columns must be part of the key, so that a key never changes
    its partition. Without partitions the new version is written beside the target and
    takes its place by two renames; use partitions for large targets. Rows are gathered by
    partition before the write, uneven partitions being split, so that a partition gets
    few files and none is written by one task alone.
    """
    if mode not in MODES:
        raise SpecError(f'Unknown load mode "{mode}".')
    if mode == "replace":
        _write(batch, "overwrite", path, partition_by)
        return
    if mode == "upsert":
        check_keys(batch, keys)
        if not set(partition_by) <= set(keys):
            raise SpecError("The partition columns of an upsert must belong to its key.")
    target = _stored(spark, path, batch, partition_by) if path_exists(spark, path) else None
    if target is not None:
        batch = aligned(batch, target)
    if mode == "append":
        _write(batch, "append", path, partition_by)
        return
    staged = shared_dir(spark, "upsert")
    latest_per_key(batch, keys, order).write.parquet(staged)
    latest = spark.read.schema(batch.schema).parquet(staged)
    try:
        no_key = reduce(or_, [qcol(name).isNull() for name in keys])
        if not latest.filter(no_key).isEmpty():
            raise SpecError(f'A row of the batch has NULL in its key ({", ".join(keys)}).')
        if target is None:
            _write(latest, "errorifexists", path, partition_by)
        elif partition_by:
            touched = latest.select(*[qcol(name) for name in partition_by]).distinct()
            # One row per touched folder of the target; the scan skips all other folders.
            current = target.join(broadcast_if_small(touched), list(partition_by), "left_semi").select(*[qcol(c) for c in target.columns])
            merged = _merged(current, latest, latest, keys, partition_by)
            writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(*partition_by).parquet(path)
        else:
            beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
            _merged(target, latest, latest, keys, ()).write.parquet(f"{beside}.new")
            rename_path(spark, path, f"{beside}.old")
            rename_path(spark, f"{beside}.new", path)
            remove_path(spark, f"{beside}.old")
    finally:
        remove_path(spark, staged)


def load_spec(spark: SparkSession, spec: TableSpec, batch: DataFrame, path: str, order: Sequence[Column] = (), partition_by: Sequence[str] = ()) -> None:
    """Loads the rows of a spec as its flags say: replace, append, or upsert by its key."""
    load(spark, batch, path, mode_of(spec.incremental, spec.primary_key), spec.primary_key, order, partition_by)


def _stored(spark: SparkSession, path: str, batch: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The target with its own columns; those in folder names carry no type and take the batch's."""
    types = {f.name: f.dataType for f in batch.schema.fields if f.name in partition_by}
    own = spark.read.parquet(path).schema
    return spark.read.schema(T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in own.fields])).parquet(path)


def aligned(batch: DataFrame, target: DataFrame) -> DataFrame:
    """The batch in the target's column order; refused if columns are missing, new, or of another type."""
    mine = {f.name: f.dataType for f in batch.schema.fields}
    stored = {f.name: f.dataType for f in target.schema.fields}
    for name in stored.keys() | mine.keys():
        if name not in mine or name not in stored:
            raise SpecError(f'Column "{name}" is not in both the batch and its target.')
        if mine[name].simpleString() != stored[name].simpleString():
            raise SpecError(f'Column "{name}" is {mine[name].simpleString()} in the batch and {stored[name].simpleString()} in its target.')
    return batch.select(*[qcol(name) for name in target.columns])


def _write(df: DataFrame, mode: str, path: str, partition_by: Sequence[str]) -> None:
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
