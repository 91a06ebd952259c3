"""Sessions of a stream: runs of rows of one key with less than a gap between neighbours.

A stateful processor holds the open sessions of each key as one value and a timer for the first that
may be over. Rows may come out of order within the allowed delay: they widen a session or join two. Once
the watermark has passed a session's end by the gap, the timer writes it out with all others of
its key that are over, and a key without open sessions leaves the state.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tablepull.functions.names import qcol
from tablepull.spec import SpecError

# A batch writes its changes to the state, not the state, and counts no keys: an update would read the key first.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
# Columns of the processor's input; its rows are named tuples, so no name may start with an underscore.
_TIME, _MICROS = "session_row_time", "session_row_micros"
_OPEN = "starts array<bigint>, ends array<bigint>, counts array<bigint>"
_OVER = "session_starts array<bigint>, session_ends array<bigint>, session_counts array<bigint>"
_FACTS = "session_start timestamp, session_end timestamp, n long"

Session = tuple[int, int, int]


def merged(sessions: Sequence[Session], times: np.ndarray, gap: int) -> list[Session]:
    """Open sessions (start, end, rows) with the rows at ``times`` put in; all are microseconds."""
    times = np.sort(times)
    if len(times):
        first = np.flatnonzero(np.concatenate([[True], np.diff(times) >= gap]))
        last = np.concatenate([first[1:], [len(times)]])
        sessions = [*sessions, *((int(times[a]), int(times[b - 1]), int(b - a)) for a, b in zip(first, last))]
    out: list[Session] = []
    for start, end, n in sorted(sessions):
        if out and start - out[-1][1] < gap:
            out[-1] = (out[-1][0], max(out[-1][1], end), out[-1][2] + n)
        else:
            out.append((start, end, n))
    return out


class Sessions(StatefulProcessor):
    """The open sessions of a key in one value; a timer is pending no later than the first of them is over.

    Sessions that are over come out as one row a key and call, as every call to the state and every row costs Python time.
    """

    def __init__(self, gap: int, keys: Sequence[str]):
        self.gap, self.row = gap, Row(*keys, "session_starts", "session_ends", "session_counts")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", _OPEN)

    def _sessions(self) -> list[Session]:
        return list(zip(*(self.open.get() or ())))

    def _due(self, end: int) -> int:
        """The first millisecond at which a session that ends at ``end`` is over."""
        return -(-(end + self.gap) // 1000)

    def _settle(self, key: Any, held: list[Session], sessions: list[Session], now: int, pending: int | None) -> Iterator[Row]:
        """Writes out what is over and keeps the rest in place of ``held``; ``pending`` is the time of a timer that has not fired."""
        over = [s for s in sessions if self._due(s[1]) <= now]
        rest = [s for s in sessions if self._due(s[1]) > now]
        if rest:
            if rest != held:
                self.open.update(tuple(list(column) for column in zip(*rest)))
            first = min(self._due(end) for _, end, _ in rest)
            if pending is None or first < pending:
                self.handle.registerTimer(first)
        elif held:
            self.open.clear()
        if over:
            yield self.row(*key, *(list(column) for column in zip(*over)))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held, now = self._sessions(), timerValues.getCurrentWatermarkInMs()
        # The timer of the first held session, or an earlier one; none is left if its time has come.
        pending = min((self._due(end) for _, end, _ in held), default=None)
        sessions = merged(held, np.array([row[_MICROS] for row in rows], np.int64), self.gap)
        yield from self._settle(key, held, sessions, now, pending if pending is not None and pending > now else None)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        # A session that has grown since gets another timer.
        sessions = self._sessions()
        if sessions:
            yield from self._settle(key, sessions, sessions, max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()), None)

    def close(self) -> None:
        pass


def session_new(
    spark: SparkSession, in_dir: str, schema: T.StructType, base: str, keys: Sequence[str], column: str,
    gap_seconds: int, delay: str = "1 hour", file_format: str = "parquet", files_per_batch: int | None = None,
) -> None:
    """Takes the files that came since the last run into sessions, and stops.

    Sessions of ``keys`` end where ``gap_seconds`` or more pass without a row. Rows older than the latest time of
    earlier batches less ``delay`` are dropped, as are rows without a time. The rows of a key in one
    batch pass through one task; ``files_per_batch`` bounds how many these are.
    """
    for name in [*keys, column]:
        if name not in schema.names:
            raise SpecError(f'Column "{name}" was not found in the table.')
    kinds = {f.name: f.dataType for f in schema.fields}
    session = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(key, spark.conf.get(key))
    for key, value in STATE_STORE.items():
        session.conf.set(key, value)
    reader = session.readStream.format(file_format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    at = qcol(column).cast("timestamp")
    rows = reader.load(in_dir).select(*[qcol(k) for k in keys], at.alias(_TIME), F.unix_micros(at).alias(_MICROS)).filter(f"{_TIME} is not null")
    out = T.StructType([*(T.StructField(k, kinds[k]) for k in keys), *T._parse_datatype_string(_OVER).fields])
    over = rows.withWatermark(_TIME, delay).groupBy(*[qcol(k) for k in keys])
    over = over.transformWithState(Sessions(gap_seconds * 1_000_000, keys), out, "Append", "EventTime")
    closed = _each(over, keys, "session_starts", "session_ends", "session_counts")
    query = closed.writeStream.format("parquet").outputMode("append").option("path", f"{base}/closed").option("checkpointLocation", f"{base}/sessions").trigger(availableNow=True).start()
    query.awaitTermination()


def closed_sessions(spark: SparkSession, base: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """(keys, session_start, session_end, n) of the sessions that are over."""
    kinds = {f.name: f.dataType for f in schema.fields}
    fields = [T.StructField(k, kinds[k]) for k in keys]
    return spark.read.schema(T.StructType([*fields, *T._parse_datatype_string(_FACTS).fields])).parquet(f"{base}/closed")


def open_sessions(spark: SparkSession, base: str, keys: Sequence[str]) -> DataFrame:
    """The same of the sessions that are still open, read from the state of the stream."""
    state = spark.read.format("statestore").option("stateVarName", "open").load(f"{base}/sessions")
    held = state.select(*[F.col("key").getField(k).alias(k) for k in keys], "value.starts", "value.ends", "value.counts")
    return _each(held, keys, "starts", "ends", "counts")


def _each(lists: DataFrame, keys: Sequence[str], starts: str, ends: str, counts: str) -> DataFrame:
    """A row for each session of rows that hold several."""
    rows = lists.select(*[qcol(k) for k in keys], F.explode(F.arrays_zip(F.col(starts).alias("a"), F.col(ends).alias("b"), F.col(counts).alias("n"))).alias("s"))
    return rows.select(*[qcol(k) for k in keys], F.timestamp_micros("s.a").alias("session_start"), F.timestamp_micros("s.b").alias("session_end"), F.col("s.n").alias("n"))
