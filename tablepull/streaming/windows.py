"""Counts per event-time window of a stream, with the rows that came too late in a table of their own.

A batch may close windows: those that end at or before its watermark, the latest time of all earlier
batches less the allowed delay. Rows of closed windows go to the late table. All others go on to a
second stream, whose windows Spark keeps as state and writes once they are closed. Every row is
in a closed window, an open one or the late table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepull.functions.names import qcol
from tablepull.session import child_names, path_exists
from tablepull.spec import SpecError

# The window of a row while it is under way.
_WINDOW = "__window"


def _facts(value: str) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.min(qcol(value)).alias("lowest"), F.max(qcol(value)).alias("highest")]


def _split(base: str, column: str, delay: str, width: str):
    """Deals a batch out into rows in time and late ones; a batch that runs again writes the same anew."""

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = [n for n in child_names(spark, f"{base}/marks") if n.startswith("batch=") and int(n[6:]) < number]
        mark = F.lit(None).cast("timestamp")
        if before:
            # One row a batch: the latest time up to it. A mark is whole milliseconds, as the stream's own is.
            latest = spark.read.schema("latest timestamp").parquet(*[f"{base}/marks/{n}" for n in before]).agg(F.max("latest")).first()[0]
            mark = F.date_trunc("millisecond", F.lit(latest).cast("timestamp")) - F.expr(f"INTERVAL {delay}")
        # The window function drops rows without a time, so these get one for it.
        at = F.coalesce(qcol(column).cast("timestamp"), F.timestamp_seconds(F.lit(0)))
        late = qcol(column).isNull() | F.coalesce(F.window(at, width).getField("end") <= mark, F.lit(False))
        batch = batch.withColumn("__late", late)
        for name, part in (("in_time", batch.filter("not __late")), ("late", batch.filter("__late"))):
            part.drop("__late").write.mode("overwrite").parquet(f"{base}/{name}/batch={number}")
        batch.agg(F.max(qcol(column).cast("timestamp")).alias("latest")).write.mode("overwrite").parquet(f"{base}/marks/batch={number}")

    return put


def window_new(
    spark: SparkSession, in_dir: str, schema: T.StructType, base: str, column: str, keys: Sequence[str], value: str,
    width: str = "1 hour", delay: str = "1 hour", file_format: str = "parquet",
) -> None:
    """Takes the files that came since the last run into windows, and stops.

    Windows are ``width`` long; per window and ``keys`` the rows, the lowest and the highest ``value``
    are kept. A row is late if its window ended ``delay`` or more before the latest time
    of an earlier batch. Rows without a time are late, too: no window holds them. Everything lives under ``base``: the rows
    in time and the late rows, the closed windows and both checkpoints.
    """
    if column not in schema.names:
        raise SpecError(f'Column "{column}" was not found in the table.')
    timed = spark.readStream.format(file_format).schema(schema).load(in_dir)
    first = timed.writeStream.foreachBatch(_split(base, column, delay, width)).option("checkpointLocation", f"{base}/split").trigger(availableNow=True).start()
    first.awaitTermination()
    if not path_exists(spark, f"{base}/in_time"):
        return
    rows = spark.readStream.schema(schema).parquet(f"{base}/in_time/*")
    rows = rows.withColumn(_WINDOW, qcol(column).cast("timestamp")).withWatermark(_WINDOW, delay)
    grouped = rows.groupBy(F.window(_WINDOW, width).alias("window"), *[qcol(k) for k in keys]).agg(*_facts(value))
    closed = grouped.select(F.col("window.start").alias("window_start"), *[qcol(k) for k in keys], "n", "lowest", "highest")
    second = closed.writeStream.format("parquet").outputMode("append").option("path", f"{base}/closed").option("checkpointLocation", f"{base}/windows").trigger(availableNow=True).start()
    second.awaitTermination()


def closed_windows(spark: SparkSession, base: str, schema: T.StructType, keys: Sequence[str], value: str) -> DataFrame:
    """(window_start, keys, n, lowest, highest) of the windows that no row in time can change any more."""
    kinds = {f.name: f.dataType for f in schema.fields}
    fields = [T.StructField("window_start", T.TimestampType()), *[T.StructField(k, kinds[k]) for k in keys], T.StructField("n", T.LongType())]
    fields += [T.StructField(name, kinds[value]) for name in ("lowest", "highest")]
    return spark.read.schema(T.StructType(fields)).parquet(f"{base}/closed")


def open_windows(spark: SparkSession, base: str, keys: Sequence[str]) -> DataFrame:
    """The same of the windows that are still open, read from the state of the stream."""
    state = spark.read.format("statestore").load(f"{base}/windows")
    named = [F.col("key").getField(k).alias(k) for k in keys]
    # Partial results stand in the order in which they were asked for.
    held = [F.col("value").getField(f.name).alias(to) for f, to in zip(state.schema["value"].dataType.fields, ("n", "lowest", "highest"))]
    return state.select(F.col("key.window.start").alias("window_start"), *named, *held)


def late_rows(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{base}/late/*")
