"""One CSV file read by many tasks, though its values hold line breaks.

The text source cuts a file into byte ranges and these into lines. Whether a line begins inside a
quoted value depends on all quotes before it: each range counts its own, a scan over the ranges (one
row each) says in which state each one begins, and inside a range a running count says it of
each line. A line that begins and ends outside of quotes is a record; the others are put together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepull.functions.names import qcol, quoted
from tablepull.operators.sinks import READ_OPTIONS
from tablepull.session import broadcast_if_small, shared_dir

_RANGE = ["file", "at"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the range they were read in, their order in it, and whether their quotes are odd in number."""
    text = spark.read.option("lineSep", "\n").text(path)
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2
    place = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")
    return text.select(*place, F.monotonically_increasing_id().alias("no"), "value", odd.alias("odd"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the records of the files at ``path``, each as it stands in its file, line breaks included.

    The lines of a range are shuffled once and put together to records there; only what lies around the border of
    two ranges meets again. A range is one task's work: its size is ``spark.sql.files.maxPartitionBytes``.
    """
    lines = _lines(spark, path)
    files = Window.partitionBy("file").orderBy("at")
    ranges = lines.groupBy(*_RANGE).agg(F.sum("odd").alias("odds"))
    before = F.coalesce(F.sum("odds").over(files.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select(*_RANGE, (before % 2).alias("begins"))
    inside = Window.partitionBy(*_RANGE).orderBy("no")
    earlier = F.coalesce(F.sum("odd").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row a range. A line outside of quotes opens a record; lines before the first one belong to an earlier range's last.
    lines = lines.join(broadcast_if_small(ranges), _RANGE).withColumn("opens", ((F.col("begins") + earlier) % 2 == 0).cast("long"))
    lines = lines.withColumn("nth", F.sum("opens").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    parts = F.array_sort(F.collect_list(F.struct("no", "value")))
    staged = shared_dir(spark, "csv-split")
    lines.groupBy(*_RANGE, "nth").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("record")).write.parquet(staged)
    pieces = spark.read.parquet(staged)

    opened = pieces.groupBy(*_RANGE).agg(F.max("nth").alias("last"))
    runs_on = F.coalesce(F.lead("begins").over(files), F.lit(0)) == 1
    ranges = ranges.join(opened, _RANGE).withColumn("runs_on", runs_on)
    # Records that run over a border, counted along the file.
    crossing = F.sum(F.when(F.col("runs_on") & (F.col("last") > 0), 1).otherwise(0)).over(files.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = pieces.join(broadcast_if_small(ranges.withColumn("crossing", crossing)), _RANGE)
    cut_off = F.col("runs_on") & (F.col("nth") == F.col("last"))
    whole = placed.filter((F.col("nth") > 0) & ~cut_off).select("record")
    # A piece that an earlier range opened belongs to the record that crosses before those this range opens.
    chain = F.col("crossing") - F.when((F.col("nth") == 0) & F.col("runs_on") & (F.col("last") > 0), 1).otherwise(0)
    border = placed.filter((F.col("nth") == 0) | cut_off).select("file", chain.alias("chain"), "at", "nth", "record")
    ordered = F.array_sort(F.collect_list(F.struct("at", "nth", "record")))
    joined = border.groupBy("file", "chain").agg(F.array_join(F.transform(ordered, lambda p: p["record"]), "\n").alias("record"))
    return whole.unionByName(joined.select("record"))


def read_csv_split(spark: SparkSession, path: str, columns: Sequence[str] | T.StructType) -> DataFrame:
    """Files written by ``write_csv``, by many tasks a file; the rows come in no order.

    ``columns`` are names, and every value is text, or a schema, and values are cast to its types.
    In files of one column an empty line is a NULL; in others it is no record.
    """
    names = columns.names if isinstance(columns, T.StructType) else list(columns)
    records = csv_records(spark, path)
    if len(names) == 1:
        value = F.replace(F.expr("substring(record, 2, length(record) - 2)"), F.lit('""'), F.lit('"'))
        rows = records.select(F.when(F.col("record") != "", value).alias(names[0]))
    else:
        schema = ", ".join(f"{quoted(name)} STRING" for name in names)
        row = F.from_csv("record", F.lit(schema), {**READ_OPTIONS, "mode": "PERMISSIVE"})
        rows = records.filter("record != ''").select(row.alias("r")).select(*[F.col("r").getField(name).alias(name) for name in names])
    if not isinstance(columns, T.StructType):
        return rows
    return rows.select(*[_typed(qcol(f.name), f.dataType).alias(f.name) for f in columns.fields])


def _typed(value: Column, kind: T.DataType) -> Column:
    """Text as ``write_csv`` renders it, back in its type."""
    if isinstance(kind, T.BinaryType):
        return F.unhex(F.substring(value, F.lit(3), F.length(value)))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.from_json(value, kind)
    return value.cast(kind)
