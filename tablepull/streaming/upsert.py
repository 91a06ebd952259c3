"""New files put into a keyed target as they come, each batch once.

``foreachBatch`` may run a batch again after a failure. The target's version names the last batch
of each stream, and takes effect together with the rows of the batch, so one that is sent again
finds itself there and changes nothing.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tablepull.operators.pruned import ROWS_PER_FILE, upsert_pruned


def upsert_new(
    spark: SparkSession, in_dir: str, schema: T.StructType, checkpoint: str, path: str, keys: Sequence[str], order: Sequence[Column] = (),
    file_format: str = "parquet", files_per_batch: int | None = None, rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Takes the files that came since the last run into the target at ``path`` by key, and stops.

    A later batch wins over an earlier one; within a batch ``order`` says which row of a key is the last.
    The series of batches is named by the id that the checkpoint gives the stream: a new
    checkpoint starts a new series.
    """
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    started, source = threading.Event(), []

    def put(batch: DataFrame, number: int) -> None:
        started.wait()
        upsert_pruned(batch.sparkSession, batch, path, keys, order, (source[0], number), rows_per_file)

    query = reader.load(in_dir).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    source.append(query.id)
    started.set()
    query.awaitTermination()
