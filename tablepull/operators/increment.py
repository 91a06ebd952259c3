"""Fetching only what is new since a stored high-water mark.

The state is the text of the last value seen. A run re-sends the rows that carry
exactly that value (``>=``), so the target must be loaded by key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepull.functions.names import qcol
from tablepull.functions.render import render
from tablepull.functions.types import INCREMENT_BASE_TYPES, base_type_of
from tablepull.messages import COLUMN_NOT_FOUND, UNEXPECTED_TYPE
from tablepull.operators.toplimit import limit_batch
from tablepull.spec import SpecError


def increment_type(df: DataFrame, column: str) -> T.DataType:
    """Type of the increment column, which must exist and be a number or a timestamp."""
    if column not in df.columns:
        raise SpecError(COLUMN_NOT_FOUND.format(column=column))
    data_type = next(f.dataType for f in df.schema.fields if f.name == column)
    kind = base_type_of(data_type)
    if kind not in INCREMENT_BASE_TYPES:
        expected = '", "'.join(INCREMENT_BASE_TYPES)
        raise SpecError(UNEXPECTED_TYPE.format(column=column, type=kind, expected=expected))
    return data_type


def _value(text: str, data_type: T.DataType) -> Column:
    return F.lit(text).cast(data_type)


def since(df: DataFrame, column: str, last: str | None) -> DataFrame:
    """Rows at or after the state. Only the literal is cast, so the filter reaches the scan."""
    data_type = increment_type(df, column)
    return df if last is None else df.filter(qcol(column) >= _value(last, data_type))


def bounded_increment(df: DataFrame, column: str, low: str | None, high: str | None) -> DataFrame:
    """Rows from the state up to a mark read beforehand: rows added meanwhile wait for the next run.

    Without a state, rows without a value belong to the increment too.
    """
    data_type = increment_type(df, column)
    if high is None:
        return df.filter(qcol(column).isNull()) if low is None else df.filter(F.lit(False))
    below = qcol(column) <= _value(high, data_type)
    return df.filter(below | qcol(column).isNull()) if low is None else since(df, column, low).filter(below)


def max_watermark(df: DataFrame, column: str) -> DataFrame:
    """The largest value as text, in one row; NULL if there is none."""
    data_type = increment_type(df, column)
    highest = df.agg(F.max(qcol(column)).alias("last_value"))
    return highest.select(render(F.col("last_value"), data_type).alias("last_value"))


def last_watermark(batch: DataFrame, column: str) -> DataFrame:
    """The value in the last row of an ordered batch, which is its largest value."""
    return max_watermark(batch, column)


def read_mark(mark: DataFrame) -> str | None:
    return mark.first()["last_value"]


def increment_health(df: DataFrame, column: str) -> DataFrame:
    """What makes an increment column unsafe: NULLs, and many rows sharing one value.

    Values are counted before they are compared, so a value that a third of the rows
    carry reaches the shuffle as one row per task.
    """
    data_type = increment_type(df, column)
    value = F.col("value")
    counts = df.groupBy(qcol(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    facts = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(value.isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
        F.max_by(F.when(value.isNotNull(), F.col("n")), value).alias("ties_at_max"),
        F.max(F.when(value.isNotNull(), F.col("n"))).alias("max_ties"),
    )
    return facts.select(
        "rows",
        "nulls",
        render(F.col("lowest"), data_type).alias("min_value"),
        render(F.col("highest"), data_type).alias("max_value"),
        "ties_at_max",
        "max_ties",
    )


def guard_progress(ties: int, beyond: int, limit: int, state: str, column: str) -> None:
    """Refuses a limited run that can never advance: rows wait beyond the state, and its ties fill the limit.

    A table without rows beyond the state is caught up: its run sends rows of the state again.
    """
    if beyond and ties >= limit:
        raise SpecError(
            f'The increment stalls: {ties} rows share the value "{state}" of column "{column}", '
            f"and the limit is {limit}. Raise the limit above the number of ties."
        )


@dataclass(frozen=True)
class Increment:
    """A batch to export, and the mark read before it, beyond which no row is taken."""

    batch: DataFrame
    high: str | None


def plan_increment(df: DataFrame, column: str, state: str | None, limit: int | None = None, tie_break: tuple[str, ...] = ()) -> Increment:
    """The rows of the next run.

    A run is bounded by the mark read before it, looked up among the new rows only. A
    limited run takes the first ``limit`` of these rows in column order; one that could
    never advance is refused here, before anything is written.
    """
    data_type = increment_type(df, column)
    new = since(df, column, state)
    facts = [render(F.max(qcol(column)), data_type).alias("high")]
    if limit is not None and state is not None:
        value = _value(state, data_type)
        facts += [F.count_if(qcol(column) == value).alias("ties"), F.count_if(qcol(column) > value).alias("beyond")]
    found = new.agg(*facts).first()
    if len(facts) > 1:
        guard_progress(found["ties"], found["beyond"], limit, state, column)
    frozen = bounded_increment(df, column, state, found["high"])
    return Increment(frozen if limit is None else limit_batch(frozen, column, limit, tie_break), found["high"])


def run_increment(df: DataFrame, column: str, state: str | None, limit: int | None = None, tie_break: tuple[str, ...] = ()) -> tuple[DataFrame, str | None]:
    """The batch of the next run and the state after it; an empty run keeps the state."""
    data_type = increment_type(df, column)
    planned = plan_increment(df, column, state, limit, tie_break)
    facts = planned.batch.agg(
        F.count(F.lit(1)).alias("rows"),
        render(F.max(qcol(column)), data_type).alias("last_value"),
    ).first()
    return planned.batch, facts["last_value"] if facts["last_value"] is not None else state
