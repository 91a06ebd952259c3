"""Overlap join: all pairs of intervals that share a moment, by key.

Intervals live in a hierarchy of buckets whose widths double. Each one has the level whose
buckets are just wider than itself, so it touches two of them at most. Two intervals meet at the
wider one's level: there the wider one stands at its own level and the other one is
sent up. A pair that shares two buckets is told only in the bucket of its reference point, the later
of the two starts, so none comes twice and nothing has to be made distinct.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepull.functions.names import qcol
from tablepull.functions.rows import row_hash
from tablepull.spec import SpecError

# Rows sent up that one bucket of a level should hold at most; beyond, they are dealt out.
BUCKET_ROWS = 200_000
SHARES = 256


def _number(df: DataFrame, name: str) -> Column:
    """A start or an end as a whole number: times as microseconds, dates as days."""
    kind = next((f.dataType for f in df.schema.fields if f.name == name), None)
    if kind is None:
        raise SpecError(f'Column "{name}" was not found in the table.')
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(qcol(name).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(qcol(name)).cast("long")
    if isinstance(kind, T.IntegralType):
        return qcol(name).cast("long")
    raise SpecError(f'Column "{name}" must be a whole number, a date or a timestamp to bound intervals.')


def _leveled(df: DataFrame, keys: Sequence[str], interval: tuple[str, str], columns: dict[str, str], side: str) -> DataFrame:
    """The wanted columns with the bounds as numbers and the level: the power of two that is at least the length."""
    low, high = (_number(df, name) for name in interval)
    known = [qcol(name).alias(f"__key{i}") for i, name in enumerate(keys)]
    wanted = F.struct(*[qcol(name).alias(f"c{i}") for i, name in enumerate(columns)])
    out = df.select(*known, low.alias(f"{side}_low"), high.alias(f"{side}_high"), row_hash(df).alias(f"{side}_spread"), wanted.alias(side))
    length = F.col(f"{side}_high") - F.col(f"{side}_low")
    # The binary digits of length - 1: exact for whole numbers, unlike a logarithm.
    level = F.when(length == 1, 0).otherwise(F.length(F.bin(length - 1))).cast("int")
    return out.filter(F.col(f"{side}_low") < F.col(f"{side}_high")).withColumn(f"{side}_level", level)


def _facts(a: DataFrame, b: DataFrame) -> tuple[dict[int, int], dict[int, int], int, int]:
    """Rows by level on both sides (64 levels at most) and the span of all starts."""
    counts, lows, highs = [], [], []
    for side, df in (("l", a), ("r", b)):
        rows = df.groupBy(f"{side}_level").agg(F.count(F.lit(1)).alias("n"), F.min(f"{side}_low").alias("low"), F.max(f"{side}_high").alias("high")).collect()
        counts.append({row[0]: row["n"] for row in rows})
        lows += [row["low"] for row in rows]
        highs += [row["high"] for row in rows]
    return counts[0], counts[1], min(lows, default=0), max(highs, default=0)


def _spread(df: DataFrame, side: str, partner: list[int], shares: dict[int, int], up_from: int) -> DataFrame:
    """Rows at home at their own level, in all its shares, and sent up to the levels of the other side's rows, each to one share.

    A row goes up to levels at least ``up_from`` above its own.
    """
    own, share_of = F.col(f"{side}_level"), F.col(f"{side}_spread")
    spots = []
    for level in sorted(shares):
        buckets = F.sequence(F.shiftright(f"{side}_low", level), F.shiftright(F.col(f"{side}_high") - 1, level))

        def at(share: Column, home: bool, level: int = level, buckets: Column = buckets) -> Column:
            return F.transform(buckets, lambda x: F.struct(F.lit(level).alias("level"), x.alias("bucket"), share.alias("share"), F.lit(home).alias("home")))

        none = F.array().cast("array<struct<level: int, bucket: bigint, share: int, home: boolean>>")
        home = F.flatten(F.array(*[at(F.lit(i), True) for i in range(shares[level])]))
        spots.append(F.when(own == level, home).otherwise(none))
        if level in partner:
            up = at(F.pmod(share_of, F.lit(shares[level])).cast("int"), False)
            spots.append(F.when(own + up_from <= level, up).otherwise(none))
    out = df.withColumn("spot", F.explode(F.flatten(F.array(*spots)))).drop(f"{side}_level", f"{side}_spread")
    return out.select("*", "spot.level", "spot.bucket", "spot.share", F.col("spot.home").alias(f"{side}_home")).drop("spot")


def overlap_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_interval: tuple[str, str], right_interval: tuple[str, str],
    left_columns: dict[str, str], right_columns: dict[str, str], bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """All pairs of rows with equal keys whose intervals [start, end) share a moment, each once.

    The dictionaries map the columns wanted from either side to their names in the result. Intervals
    that are empty, reversed or have a NULL bound match nothing, nor do NULL keys. Bounds are
    timestamps, dates or whole numbers, of one kind on both sides. Lengths may range from the
    smallest unit to the whole table. Where a bucket of a level holds more than ``bucket_rows`` rows that
    are sent up, they are dealt out, and the rows at home there are copied to every share.
    """
    clash = set(left_columns.values()) & set(right_columns.values())
    if clash:
        raise SpecError(f'Both sides bring a column "{clash.pop()}".')
    for name in keys:
        if name not in left.columns or name not in right.columns:
            raise SpecError(f'Column "{name}" was not found in the table.')
    a, b = _leveled(left, keys, left_interval, left_columns, "l"), _leveled(right, keys, right_interval, right_columns, "r")
    in_a, in_b, low, high = _facts(a, b)
    shares = {}
    for level in {*in_a, *in_b, 0}:
        up = max(sum(n for at, n in side.items() if at <= level) for side in (in_a, in_b))
        buckets = max(1, (high - low) >> level)
        shares[level] = min(SHARES, max(1, -(-up // (buckets * bucket_rows))))
    place = [f"__key{i}" for i in range(len(keys))]
    # Of two rows of one level the left one counts as sent up.
    a, b = _spread(a, "l", list(in_b), shares, 0), _spread(b, "r", list(in_a), shares, 1)
    met = a.join(b, [*place, "level", "bucket", "share"])
    touch = (F.col("l_low") < F.col("r_high")) & (F.col("r_low") < F.col("l_high"))
    point = F.expr("shiftright(greatest(l_low, r_low), level)")
    met = met.filter((F.col("l_home") != F.col("r_home")) & touch & (F.col("bucket") == point))
    return met.select(
        *[F.col("l").getField(f"c{i}").alias(to) for i, to in enumerate(left_columns.values())],
        *[F.col("r").getField(f"c{i}").alias(to) for i, to in enumerate(right_columns.values())],
    )
