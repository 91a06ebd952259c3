"""A keyed target whose upserts rewrite only the files that can hold a changed key.

The target is a folder of immutable Parquet files. Beside them stand, for every file, its key range
and a Bloom filter of its keys. A version lists the files that count, with their ranges, and which
batches of which sources are in it; it is written aside and takes effect by one rename, so a reader
sees the old or the new one, never a part. A batch that is sent again finds itself in the list and
changes nothing.

    data/<commit>/part-*.parquet    rows, clustered by key
    filters/<commit>                (file, block, bits) of the files of a commit
    _versions/<n>/files             (file, commit, rows, blocks, low, high) of the files that count
    _versions/<n>/batches           (source, batch) last batch of each source
    _versions/<n>/empty             no rows; the columns of the target
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepull.functions.names import qcol
from tablepull.operators.bloom import block_of, blocks_for, bloom_blocks, key_hash, may_hold
from tablepull.operators.keys import check_keys
from tablepull.operators.load import aligned, latest_per_key
from tablepull.session import broadcast_if_small, child_names, path_exists, remove_path, rename_path, shared_dir
from tablepull.sources.scan import stride_of
from tablepull.spec import SpecError

ROWS_PER_FILE = 1_000_000
# Key ranges are met zone by zone instead of each with each.
ZONES = 256


@dataclass(frozen=True)
class Commit:
    """What an upsert did: the version now current, the files it left alone, those it replaced, and whether it wrote at all."""

    version: int
    kept: int
    replaced: int
    written: bool


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The number of the current version; None if there is no target yet."""
    numbers = [int(name) for name in child_names(spark, f"{path}/_versions") if name.isdigit()]
    return max(numbers, default=None)


def read_target(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the current one by default."""
    version = latest_version(spark, path) if version is None else version
    if version is None:
        raise SpecError(f"There is no target at {path}.")
    return _read(spark, path, version, _files(spark, path, version))


def target_files(spark: SparkSession, path: str, version: int | None = None) -> list[str]:
    """The files of a version, relative to the target."""
    version = latest_version(spark, path) if version is None else version
    return sorted(f"data/{r['commit']}/{r['file']}" for r in _files(spark, path, version).select("commit", "file").collect())


def last_batch(spark: SparkSession, path: str, source: str) -> int | None:
    """The last batch of a source that is in the target."""
    version = latest_version(spark, path)
    if version is None:
        return None
    found = spark.read.parquet(f"{path}/_versions/{version}/batches").filter(F.col("source") == source).first()
    return found["batch"] if found else None


def upsert_pruned(
    spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str], order: Sequence[Column] = (),
    delivery: tuple[str, int] | None = None, rows_per_file: int = ROWS_PER_FILE,
) -> Commit:
    """Puts the rows of a batch into the target by key; the last row per key wins, as in ``load``.

    Files whose key range and filter rule out every changed key keep their names; the others are
    read, and their rows without the changed keys are written together with the batch, clustered by key. A
    filter's false hit costs a rewrite and nothing else. ``delivery`` (source, number) makes the
    batch one of a series: numbers up to the last one in the target are not taken again. A version
    that another writer published meanwhile makes the upsert fail without effect.
    """
    check_keys(batch, keys)
    path = path.rstrip("/")
    version = latest_version(spark, path)
    if version is not None and delivery is not None:
        last = last_batch(spark, path, delivery[0])
        if last is not None and delivery[1] <= last:
            return Commit(version, _files(spark, path, version).count(), 0, False)
    if version is not None:
        batch = aligned(batch, spark.read.parquet(f"{path}/_versions/{version}/empty"))
    staged = shared_dir(spark, "upsert")
    latest_per_key(batch, keys, order).write.parquet(staged)
    latest = spark.read.schema(batch.schema).parquet(staged)
    try:
        facts = latest.agg(F.count(F.lit(1)).alias("rows"), F.count_if(reduce(or_, [qcol(k).isNull() for k in keys])).alias("nulls")).first()
        if facts["nulls"]:
            raise SpecError(f'A row of the batch has NULL in its key ({", ".join(keys)}).')
        files = None if version is None else _files(spark, path, version)
        touched = [] if files is None or not facts["rows"] else _touched(spark, path, files, latest, keys)
        kept = 0 if files is None else files.count() - len(touched)
        commit = uuid.uuid4().hex
        merged, rows = latest, facts["rows"]
        if touched:
            names = spark.createDataFrame([(r["file"], r["commit"]) for r in touched], "file string, commit string")
            old = _read(spark, path, version, names)
            changed = latest.select(*[qcol(k).alias(f"__key{i}") for i, k in enumerate(keys)])
            same = reduce(and_, [qcol(k) == F.col(f"__key{i}") for i, k in enumerate(keys)])
            merged = old.join(broadcast_if_small(changed), same, "left_anti").unionByName(latest)
            rows += sum(r["rows"] for r in touched)
        if rows:
            parts = max(1, -(-rows // rows_per_file))
            clustered = [qcol(k) for k in keys]
            merged.repartitionByRange(parts, *clustered).sortWithinPartitions(*clustered).write.parquet(f"{path}/data/{commit}")
            fresh = _describe(spark, path, commit, keys)
            if touched:
                files = files.join(F.broadcast(names), ["file", "commit"], "left_anti")
            files = fresh if files is None else files.unionByName(fresh)
        batches = _batches(spark, path, version, delivery)
        _publish(spark, path, version, files, batches, latest.limit(0), keys)
        remove_path(spark, f"{path}/filters/{commit}.files")
        return Commit((version or 0) + 1, kept, len(touched), True)
    finally:
        remove_path(spark, staged)


def drop_versions(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Forgets all but the newest ``keep`` versions and removes the commits that none of these names; returns how many."""
    path, current = path.rstrip("/"), latest_version(spark, path)
    numbers = sorted(int(name) for name in child_names(spark, f"{path}/_versions") if name.isdigit())
    used = {r["commit"] for n in numbers[-keep:] for r in _files(spark, path, n).select("commit").distinct().collect()}
    for number in numbers[:-keep]:
        remove_path(spark, f"{path}/_versions/{number}")
    gone = [name for name in child_names(spark, f"{path}/data") if name not in used and current is not None]
    for name in gone:
        remove_path(spark, f"{path}/data/{name}")
        remove_path(spark, f"{path}/filters/{name}")
    return len(gone)


def _files(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/_versions/{version}/files")


def _read(spark: SparkSession, path: str, version: int, files: DataFrame) -> DataFrame:
    """The rows of some files; their names pass through the driver, one per file."""
    empty = spark.read.parquet(f"{path}/_versions/{version}/empty")
    names = [f"{path}/data/{r['commit']}/{r['file']}" for r in files.select("commit", "file").collect()]
    return spark.read.schema(empty.schema).parquet(*names) if names else empty


def _touched(spark: SparkSession, path: str, files: DataFrame, latest: DataFrame, keys: Sequence[str]) -> list:
    """(file, commit, rows) of the files that can hold a key of ``latest``: in their range, then in their filter."""
    lows = sorted(r["k0"] for r in files.select("low.k0").distinct().collect())
    cuts = lows[:: max(1, -(-len(lows) // ZONES))]
    first, last = (stride_of(F.col(f"{end}.k0"), cuts) for end in ("low", "high"))
    ranges = files.withColumn("zone", F.explode(F.sequence(first, last)))
    asked = latest.select(_key(keys).alias("key"), key_hash(keys).alias("hash"), stride_of(qcol(keys[0]), cuts).alias("zone"))
    inside = (F.col("key") >= F.col("low")) & (F.col("key") <= F.col("high"))
    pairs = asked.join(ranges, "zone").filter(inside).select("file", "commit", "rows", "hash", block_of(F.col("hash"), F.col("blocks")).alias("block"))
    commits = [r["commit"] for r in files.select("commit").distinct().collect()]
    filters = spark.read.parquet(*[f"{path}/filters/{c}" for c in commits]) if commits else None
    if filters is None:
        return []
    hits = pairs.join(filters, ["file", "block"]).filter(may_hold(F.col("bits"), F.col("hash")))
    return hits.select("file", "commit", "rows").distinct().collect()


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*[qcol(name).alias(f"k{i}") for i, name in enumerate(keys)])


def _describe(spark: SparkSession, path: str, commit: str, keys: Sequence[str]) -> DataFrame:
    """Ranges of the files of a commit, and their filters, which are written."""
    data = spark.read.parquet(f"{path}/data/{commit}")
    rows = data.select(F.col("_metadata.file_name").alias("file"), _key(keys).alias("key"), key_hash(keys).alias("hash"))
    facts = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"))
    facts = facts.select("file", F.lit(commit).alias("commit"), "rows", blocks_for(F.col("rows")).alias("blocks"), "low", "high")
    staged = f"{path}/filters/{commit}.files"
    facts.write.parquet(staged)
    facts = spark.read.parquet(staged)
    sized = rows.select("file", "hash").join(F.broadcast(facts.select("file", "blocks")), "file")
    bloom_blocks(sized, ["file"], "hash", "blocks").write.parquet(f"{path}/filters/{commit}")
    return facts


def _batches(spark: SparkSession, path: str, version: int | None, delivery: tuple[str, int] | None) -> DataFrame:
    schema = "source string, batch long"
    known = spark.createDataFrame([], schema) if version is None else spark.read.parquet(f"{path}/_versions/{version}/batches")
    if delivery is None:
        return known
    return known.filter(F.col("source") != delivery[0]).unionByName(spark.createDataFrame([delivery], schema))


def _publish(spark: SparkSession, path: str, version: int | None, files: DataFrame | None, batches: DataFrame, empty: DataFrame, keys: Sequence[str]) -> None:
    aside, number = f"{path}/_versions/.{uuid.uuid4().hex}", (version or 0) + 1
    if files is None:
        kinds = {f.name: f.dataType for f in empty.schema.fields}
        ends = T.StructType([T.StructField(f"k{i}", kinds[k]) for i, k in enumerate(keys)]).simpleString()
        files = spark.createDataFrame([], f"file string, commit string, rows long, blocks int, low {ends}, high {ends}")
    files.write.parquet(f"{aside}/files")
    batches.write.parquet(f"{aside}/batches")
    empty.write.parquet(f"{aside}/empty")
    if path_exists(spark, f"{path}/_versions/{number}"):
        remove_path(spark, aside)
        raise SpecError(f"Another writer published version {number} of {path}; run the upsert again.")
    rename_path(spark, aside, f"{path}/_versions/{number}")
