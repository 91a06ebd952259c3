"""The first n rows in a total order, for small and for very large n."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepull.functions.names import qcol
from tablepull.functions.rows import comparable, row_hash
from tablepull.spec import SpecError

# Up to this many keys one task may hold while the last one is located.
HEAP_ROWS = 10_000
SPLITTERS = 64
SAMPLES = 2_000
COPIES_PER_ROW = 10_000


def limit_batch(df: DataFrame, column: str, n: int, tie_break: tuple[str, ...] = (), heap_rows: int = HEAP_ROWS) -> DataFrame:
    """The first ``n`` rows ordered by ``column`` (NULLs last), ``tie_break`` (NULLs last), a hash of the row, then all columns.

    The n-th value of the first column is located by reading that column alone; the rows below it are a
    filter that reaches the scan, and only rows equal to it are told apart by the next column, and so on, the hash
    last. The same rows come at every ``n``, on every run and in every layout, in the order in which the source gives them.
    ``heap_rows`` only says how a value is located: up to it by sorting, beyond by counting.
    """
    if n <= 0:
        return df.limit(0)
    return _first(df, [column, *tie_break], n, heap_rows)


def _first(df: DataFrame, order: list[str], n: int, heap_rows: int) -> DataFrame:
    value = _value(df, order[0]) if order else row_hash(df)
    values = df.select(value.alias("k"))
    kind = values.schema["k"].dataType
    cut = _next(values, kind, n) if n <= heap_rows else _nth(values, kind, n, heap_rows)
    if cut is None:
        return df
    if cut.value is None:
        below, equal = df.filter(value.isNotNull()), df.filter(value.isNull())
    else:
        last = _from_text(cut.value, kind)
        below, equal = df.filter(value < last), df.filter(value == last)
    rest = n - cut.rows_below
    if rest == 0:
        return below
    if rest == cut.rows_equal:
        return df.filter(value <= last)
    return below.unionByName(_first(equal, order[1:], rest, heap_rows) if order else _some(equal, rest))


def _value(df: DataFrame, name: str) -> Column:
    """A column in a form that can be compared with a literal: nested ones as JSON."""
    kind = next(f.dataType for f in df.schema.fields if f.name == name)
    return F.to_json(qcol(name)) if isinstance(kind, (T.ArrayType, T.StructType)) else dict(zip(df.columns, comparable(df)))[name]


@dataclass(frozen=True)
class _Cut:
    """A value (None: NULL), the rows below it, and those equal to it where they are known."""

    value: str | None
    rows_below: int
    rows_equal: int | None


def _next(values: DataFrame, kind: T.DataType, n: int) -> _Cut | None:
    """The value after the n-th one: if that is another one, the rows below it are the first n. None if there are no more than n rows.

    One job: the first n + 1 values, of which only the last one and its number are returned.
    """
    k = F.col("k")
    counts = values.orderBy(k.asc_nulls_last()).limit(n + 1).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    nulls = F.coalesce(F.sum(F.when(k.isNull(), F.col("n"))), F.lit(0))
    found = counts.agg(F.sum("n").alias("rows"), nulls.alias("nulls"), _to_text(F.max("k"), kind).alias("last"), F.max_by("n", "k").alias("ties")).first()
    if (found["rows"] or 0) <= n:
        return None
    if found["nulls"]:
        return _Cut(None, found["rows"] - found["nulls"], None)
    return _Cut(found["last"], found["rows"] - found["ties"], None)


def _nth(values: DataFrame, kind: T.DataType, n: int, heap_rows: int) -> _Cut | None:
    """The n-th value in order, with the rows below it and equal to it; None if there are no more than n rows.

    Each pass counts the rows between some sampled values and goes on between two of
    them. A sampled value is counted by itself, so one that many rows share is
    found at once and the open interval always shrinks.
    """
    known, total = values.agg(F.count("k"), F.count(F.lit(1))).first()
    if n >= total:
        return None
    if n >= known:
        return _Cut(None, known, total - known)
    values, total = values.filter("k is not null"), known
    k = F.col("k")
    window, before, size = values, 0, total
    while True:
        rank = n - before
        if rank <= heap_rows:
            text = window.orderBy(k).limit(rank).agg(_to_text(F.max("k"), kind)).first()[0]
            break
        if size - rank < heap_rows:
            text = window.orderBy(k.desc()).limit(size - rank + 1).agg(_to_text(F.min("k"), kind)).first()[0]
            break
        found = _splitters(window, size, kind)
        splitters = [_from_text(item, kind) for item in found]
        slots = window.groupBy(_slot(k, splitters, 0, len(splitters)).alias("slot")).count()
        counts = {row["slot"]: row["count"] for row in slots.collect()}
        chosen = 0
        while before + counts.get(chosen, 0) < n:
            before += counts.get(chosen, 0)
            chosen += 1
            if chosen > 2 * len(splitters):
                raise SpecError("The table lost rows while the batch was being located; run it again.")
        i, exact = divmod(chosen, 2)
        if exact:
            return _Cut(found[i], before, counts[chosen])
        if i > 0:
            window = window.filter(k > splitters[i - 1])
        if i < len(splitters):
            window = window.filter(k < splitters[i])
        size = counts[chosen]

    value = _from_text(text, kind)
    below, equal = window.agg(F.count_if(k < value), F.count_if(k == value)).first()
    return _Cut(text, before + below, equal)


def _slot(k: Column, splitters: list[Column], first: int, last: int) -> Column:
    """Odd for the splitter a key equals, even for the gap it lies in; by bisection."""
    if first == last:
        return F.lit(2 * first)
    middle = (first + last) // 2
    return (
        F.when(k < splitters[middle], _slot(k, splitters, first, middle))
        .when(k == splitters[middle], 2 * middle + 1)
        .otherwise(_slot(k, splitters, middle + 1, last))
    )


def _splitters(window: DataFrame, size: int, kind: T.DataType) -> list[str]:
    """Up to 64 values spread over the window. They steer the search; the counts decide."""
    fraction = min(1.0, SAMPLES / size)
    sample = window.sample(fraction=fraction, seed=size % 1_000_003) if fraction < 1 else window
    drawn = sample.agg(F.sort_array(F.collect_list("k")).alias("ks")).select("ks", F.size("ks").alias("n"))
    step = F.greatest(F.floor(F.col("n") / SPLITTERS), F.lit(1)).cast("int")
    spread = F.filter("ks", lambda _, i: i % step == F.floor(step / 2)).alias("ks")
    row = drawn.select(F.transform(spread, lambda k: _to_text(k, kind)).alias("texts")).first()
    if row["texts"]:
        return list(dict.fromkeys(row["texts"]))
    return [window.select(_to_text(F.col("k"), kind)).first()[0]]


def _to_text(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(data_type, T.BinaryType):
        return F.hex(column)
    return column.cast("string")


def _from_text(text: str, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.TimestampType):
        return F.timestamp_micros(F.lit(int(text)))
    if isinstance(data_type, T.BinaryType):
        return F.unhex(F.lit(text))
    return F.lit(text).cast(data_type)


def _some(df: DataFrame, n: int) -> DataFrame:
    """``n`` of rows of one key: copies of a row, or rows whose hashes collide, by all columns."""
    names = df.columns
    # Copies of a row fold into one row per task before the shuffle; what is left is one
    # row, or a few if a hash collides.
    rows = df.groupBy(*[qcol(name) for name in names]).agg(F.count(F.lit(1)).alias("__copies"))
    fixed_order = Window.orderBy(*comparable(df))
    earlier = F.sum("__copies").over(fixed_order.rowsBetween(Window.unboundedPreceding, -1))
    take = F.least(F.col("__copies"), F.lit(n) - F.coalesce(earlier, F.lit(0)))
    blocks = rows.withColumn("__take", take).filter("__take > 0").withColumn(
        "__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__take") - 1) / COPIES_PER_ROW)))
    )
    rest = F.least(F.lit(COPIES_PER_ROW).cast("long"), F.col("__take") - F.col("__block") * COPIES_PER_ROW)
    return (
        blocks.repartition("__block")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), rest)))
        .select(*[qcol(name) for name in names])
    )
