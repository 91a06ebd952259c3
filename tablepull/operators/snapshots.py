"""What changed between two versions of a table: inserts, changes and deletes.

Each version has a tree of digests over ranges of its keys. Ranges are dyadic: a leaf holds the keys
that agree but for their last bits, a node the leaves that agree but for theirs, so the trees of
all versions have the same borders. Two trees are compared from the root; only below nodes that
differ are children looked at, and only the rows of leaves that differ are read and compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepull.functions.names import qcol
from tablepull.functions.rows import comparable
from tablepull.operators.keys import check_keys
from tablepull.session import broadcast_if_small, child_names, shared_dir
from tablepull.spec import SpecError

# Rows a leaf should hold, and bits by which a node is wider than its children.
LEAF_ROWS = 10_000
FANOUT_BITS = 8
# Up to this many ranges are read by a filter that reaches the scan, more by a join.
FILTER_RANGES = 200
_ROOT = 63


def position(df: DataFrame, keys: Sequence[str]) -> Column:
    """The place of a row among all keys: the key itself if it is one whole number, date or time, else its hash."""
    check_keys(df, keys)
    kind = next(f.dataType for f in df.schema.fields if f.name == keys[0])
    if len(keys) == 1 and isinstance(kind, T.IntegralType):
        return qcol(keys[0]).cast("long")
    if len(keys) == 1 and isinstance(kind, T.DateType):
        return F.unix_date(qcol(keys[0])).cast("long")
    if len(keys) == 1 and isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(qcol(keys[0]).cast("timestamp"))
    return F.xxhash64(*[qcol(k) for k in keys])


def leaf_bits(df: DataFrame, keys: Sequence[str], leaf_rows: int = LEAF_ROWS) -> int:
    """How many last bits of a position a leaf spans, so that it holds about ``leaf_rows`` rows."""
    facts = df.select(position(df, keys).alias("at")).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"), F.max("at").alias("high")).first()
    if not facts["n"] or facts["low"] is None:
        return 0
    return min(_ROOT, max(0, ((facts["high"] - facts["low"]) * leaf_rows // facts["n"]).bit_length()))


def write_digests(df: DataFrame, keys: Sequence[str], path: str, bits: int) -> None:
    """The tree of a version, a table (node, n, mixed, total) per level with a row for each node that holds rows.

    Versions that are to be compared need the same ``bits`` of a leaf. Digests do not depend on
    the order or the layout of the rows. A NULL key counts as a position of its own.
    """
    spark = df.sparkSession
    at = F.coalesce(position(df, keys), F.lit(-(2**63)))
    # Two hashes, one folded by exclusive or and one by sum, so that repeated rows do not cancel.
    rows = df.select(F.shiftright(at, bits).alias("node"), F.xxhash64(*comparable(df)).alias("h"), F.xxhash64(F.lit("sum"), *comparable(df)).alias("g"))
    leaves = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("mixed"), F.sum(F.col("g").cast("decimal(38, 0)")).alias("total"))
    leaves.write.parquet(f"{path}/bits={bits}")
    while bits < _ROOT:
        below = spark.read.parquet(f"{path}/bits={bits}")
        if below.count() <= 1 << FANOUT_BITS:
            return
        above = min(_ROOT, bits + FANOUT_BITS)
        nodes = below.groupBy(F.shiftright("node", above - bits).alias("node")).agg(F.sum("n").alias("n"), F.bit_xor("mixed").alias("mixed"), F.sum("total").cast("decimal(38, 0)").alias("total"))
        nodes.write.parquet(f"{path}/bits={above}")
        bits = above


def differing_leaves(spark: SparkSession, old_path: str, new_path: str, bits: int) -> DataFrame:
    """The leaves (node) whose digests differ, found from the highest nodes that both trees have downwards."""
    mine, other = ({int(name[5:]) for name in child_names(spark, path) if name.startswith("bits=")} for path in (old_path, new_path))
    levels = sorted(mine & other, reverse=True)
    if bits not in levels:
        raise SpecError(f"The digests have no leaves of {bits} bits.")
    open_, above = None, _ROOT
    for level in levels:
        old, new = (spark.read.parquet(f"{path}/bits={level}") for path in (old_path, new_path))
        if open_ is not None:
            near = broadcast_if_small(open_)
            old, new = (t.join(near, F.shiftright("node", above - level) == F.col("parent"), "left_semi") for t in (old, new))
        old = old.select(F.col("node"), F.struct("n", "mixed", "total").alias("old"))
        new = new.select(F.col("node"), F.struct("n", "mixed", "total").alias("new"))
        staged = shared_dir(spark, "digests")
        old.join(new, "node", "full").filter(~F.col("old").eqNullSafe(F.col("new"))).select("node").write.parquet(staged)
        open_, above = spark.read.parquet(staged).withColumnRenamed("node", "parent"), level
    return open_.withColumnRenamed("parent", "node")


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], old_digests: str, new_digests: str, bits: int) -> DataFrame:
    """(change, columns of the table) of every key whose row differs between the versions.

    ``change`` is "insert", "update" or "delete"; the columns are those of the new row, of the old one for
    a delete. Keys must be unique in each version; both need the same columns. NULLs compare as equal, also in
    keys. Of equal ranges nothing is read but their digests.
    """
    if sorted(old.columns) != sorted(new.columns):
        raise SpecError("The two versions have different columns.")
    spark, names = old.sparkSession, old.columns
    leaves = differing_leaves(spark, old_digests, new_digests, bits)
    first, second = (opened(version, keys, leaves, bits) for version in (old, new))
    a = first.select(F.struct(*[qcol(c) for c in names]).alias("old"), F.struct(*[qcol(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("k"))
    b = second.select(F.struct(*[qcol(c) for c in names]).alias("new"), F.struct(*[qcol(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("l"))
    same_key = reduce(and_, [F.col(f"k.k{i}").eqNullSafe(F.col(f"l.k{i}")) for i in range(len(keys))])
    met = a.join(b, same_key, "full")
    # Maps cannot be compared; their JSON can.
    mapped = [f.name for f in old.schema.fields if "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString()]
    value = lambda side, n: F.to_json(F.col(side).getField(n)) if n in mapped else F.col(side).getField(n)
    changed = reduce(or_, [~value("old", n).eqNullSafe(value("new", n)) for n in names])
    change = F.when(F.col("old").isNull(), "insert").when(F.col("new").isNull(), "delete").otherwise("update")
    kept = met.withColumn("change", change).filter((F.col("change") != "update") | changed)
    return kept.select("change", *[F.when(F.col("new").isNull(), F.col("old").getField(n)).otherwise(F.col("new").getField(n)).alias(n) for n in names])


def opened(version: DataFrame, keys: Sequence[str], leaves: DataFrame, bits: int) -> DataFrame:
    """The rows of some leaves: by ranges of the key if these are few, else by a join with the leaves."""
    at = F.coalesce(position(version, keys), F.lit(-(2**63)))
    kind = next(f.dataType for f in version.schema.fields if f.name == keys[0])
    found = [r["node"] for r in leaves.orderBy("node").limit(FILTER_RANGES * 16 + 1).collect()]
    ranges: list[list[int]] = []
    for node in found:
        if ranges and ranges[-1][1] == node:
            ranges[-1][1] = node + 1
        else:
            ranges.append([node, node + 1])
    if len(found) > FILTER_RANGES * 16 or len(ranges) > FILTER_RANGES:
        node = F.shiftright(at, bits)
        return version.join(broadcast_if_small(leaves.withColumnRenamed("node", "__node")), node == F.col("__node"), "left_semi")
    if not ranges:
        return version.filter(F.lit(False))
    # A plain number is compared as it is, so that the ranges reach the scan.
    plain = len(keys) == 1 and isinstance(kind, T.LongType) and all(low > -(2 ** (_ROOT - bits)) for low, _ in ranges)
    value = qcol(keys[0]) if plain else at
    ends = [(low << bits, ((high << bits) - 1)) for low, high in ranges]
    return version.filter(reduce(or_, [value.between(F.lit(low).cast("long"), F.lit(min(high, 2**63 - 1)).cast("long")) for low, high in ends]))
