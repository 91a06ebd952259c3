"""Tables and queries as DataFrames."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepull.functions.names import project, qcol, quoted
from tablepull.session import with_session
from tablepull.spec import SpecError, TableSpec

# Queries are written with "double quoted" identifiers.
QUERY_CONF = {"spark.sql.ansi.enabled": "true", "spark.sql.ansi.doubleQuotedIdentifiers": "true"}

# Finds the frame of a (schema, table) pair.
Resolver = Callable[[str, str], DataFrame]


def parquet_tables(spark: SparkSession, base: str) -> Resolver:
    """Tables stored as ``<base>/<table>.parquet``; the schema name is not part of the path."""
    return lambda schema, table: spark.read.parquet(f"{base.rstrip('/')}/{table}.parquet")


def catalog_tables(spark: SparkSession) -> Resolver:
    """Tables of the session catalogue."""
    return lambda schema, table: spark.table(f"{quoted(schema)}.{quoted(table)}")


def jdbc_tables(spark: SparkSession, options: Mapping[str, str], batch_size: int = 10_000, partition_column: str | None = None, partitions: int = 1) -> Resolver:
    """Tables of a database; see ``jdbc_options``.

    A table is read over one connection, or over ``partitions`` of them, each of which takes a stride of
    ``partition_column`` between its smallest and its largest value. A spec's own batch size and partitions go before these.
    """

    def read(schema: str, table: str) -> DataFrame:
        if partitions > 1 and partition_column:
            cuts = strides(*column_bounds(spark, options, schema, table, partition_column), partitions)
            if cuts:
                return scan_partitioned(spark, options, schema, table, partition_column, cuts, batch_size)
        return spark.read.format("jdbc").options(**jdbc_options(options, schema=schema, table=table, batch_size=batch_size)).load()

    def for_spec(spec: TableSpec) -> Resolver:
        column, parts = (spec.partition_column, spec.partitions) if spec.partition_column else (partition_column, partitions)
        return jdbc_tables(spark, options, spec.batch_size, column, parts)

    read.for_spec = for_spec
    return read


def column_bounds(spark: SparkSession, options: Mapping[str, str], schema: str, table: str, column: str) -> tuple[Any, Any]:
    """The smallest and the largest value of a column, asked of the database."""
    name = jdbc_options({}, schema=schema, table=table)["dbtable"]
    quoted_column = '"' + column.replace('"', '""') + '"'
    text = f"SELECT min({quoted_column}) AS low, max({quoted_column}) AS high FROM {name}"
    row = spark.read.format("jdbc").options(**jdbc_options(options, query=text)).load().first()
    return row["low"], row["high"]


def strides(low: Any, high: Any, parts: int) -> list[Any]:
    """Inner borders of strides of equal width between two numbers, dates or times; none if there is nothing to cut."""
    if low is None or low == high:
        return []
    if isinstance(low, int):
        return even_cuts(low, high, parts)
    return sorted({cut for cut in (low + (high - low) * i / parts for i in range(1, parts)) if low < cut < high})


def sized(resolve: Resolver, spec: TableSpec) -> Resolver:
    """The resolver with the batch size and the partitions of a spec, if it reads from a database."""
    for_spec, with_size = (getattr(resolve, name, None) for name in ("for_spec", "with_batch_size"))
    if for_spec:
        return for_spec(spec)
    return with_size(spec.batch_size) if with_size else resolve


def scan_table(resolve: Resolver, spec: TableSpec) -> DataFrame:
    """The columns a spec asks for, in its order."""
    if not spec.schema or not spec.table:
        raise SpecError("The spec names no table.")
    return project(sized(resolve, spec)(spec.schema, spec.table), spec.columns)


def scan_query(spark: SparkSession, query: str, views: Mapping[str, DataFrame] | None = None, conf: Mapping[str, str] | None = None) -> DataFrame:
    """The result of a SELECT over the given views.

    Trailing semicolons and blanks are ignored. The views and the settings live in a
    session of their own, so two queries may use one name for different tables.
    """
    session = with_session(spark, {**QUERY_CONF, **(conf or {})})
    for name, df in (views or {}).items():
        _share(session, name, df)
    return session.sql(query.rstrip("; \n\r\t"))


def _share(session: SparkSession, name: str, df: DataFrame) -> None:
    """Makes a frame of another session a view of this one."""
    passing = "tablepull_" + uuid.uuid4().hex
    df.createOrReplaceGlobalTempView(passing)
    session.table(f"global_temp.{passing}").createOrReplaceTempView(quoted(name))
    session.catalog.dropGlobalTempView(passing)


def jdbc_options(
    connection: Mapping[str, str],
    schema: str | None = None,
    table: str | None = None,
    query: str | None = None,
    batch_size: int = 10_000,
    init: Sequence[str] = (),
    partition: tuple[str, Any, Any, int] | None = None,
) -> dict[str, str]:
    """Reader options for a table or a query.

    ``partition`` is (column, lower, upper, parts). A partitioned query is passed as a
    derived table, because the reader refuses the ``query`` option there.
    """
    options = {**connection, "fetchsize": str(batch_size)}
    if query:
        text = query.rstrip("; \n\r\t")
        options["dbtable" if partition else "query"] = f"({text}) t" if partition else text
    elif table:
        names = [name for name in (schema, table) if name]
        options["dbtable"] = ".".join('"' + name.replace('"', '""') + '"' for name in names)
    else:
        raise SpecError("Give a table or a query.")
    if init:
        options["sessionInitStatement"] = "; ".join(init)
    if partition:
        column, lower, upper, parts = partition
        options.update(partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(parts))
    return options


def scan_partitioned(spark: SparkSession, connection: Mapping[str, str], schema: str, table: str, column: str, cuts: Sequence[Any], batch_size: int = 10_000) -> DataFrame:
    """A table read in parallel, one connection per stride between ``cuts``."""
    options = jdbc_options(connection, schema=schema, table=table, batch_size=batch_size)
    name = options.pop("dbtable")
    url = options.pop("url")
    return spark.read.jdbc(url, name, predicates=stride_predicates(column, cuts), properties=options)


def even_cuts(lower: int, upper: int, parts: int) -> list[int]:
    """Inner borders of strides of equal width between ``lower`` and ``upper``."""
    stride = max((upper - lower) // parts, 1)
    return [cut for cut in (lower + i * stride for i in range(1, parts)) if cut < upper]


def balanced_cuts(df: DataFrame, column: str, parts: int) -> list[Any]:
    """Inner borders that put about as many rows into each stride, for uneven columns."""
    shares = [i / parts for i in range(1, parts)]
    cuts = df.agg(F.percentile_approx(qcol(column), shares, 10_000).alias("cuts")).first()["cuts"]
    return sorted(set(cuts or []))


def stride_predicates(column: str, cuts: Sequence[Any]) -> list[str]:
    """One condition per stride: open at both ends, NULLs with the first."""
    name = '"' + column.replace('"', '""') + '"'
    texts = [str(cut) if isinstance(cut, (int, float)) else "'" + str(cut).replace("'", "''") + "'" for cut in cuts]
    if not texts:
        return ["1 = 1"]
    inner = [f"{name} >= {low} AND {name} < {high}" for low, high in zip(texts, texts[1:])]
    return [f"{name} < {texts[0]} OR {name} IS NULL", *inner, f"{name} >= {texts[-1]}"]


def stride_of(column: Column, cuts: Sequence[Any], first: int = 0) -> Column:
    """Number of the stride a value falls into, by bisection; NULL falls into the first."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    above = stride_of(column, cuts[middle + 1 :], first + middle + 1)
    return F.when(column >= F.lit(cuts[middle]), above).otherwise(stride_of(column, cuts[:middle], first))


def stride_counts(df: DataFrame, column: str, cuts: Sequence[Any]) -> DataFrame:
    """Rows per stride: shows before a parallel read whether one part would dominate it."""
    return df.groupBy(stride_of(qcol(column), cuts).alias("stride")).agg(F.count(F.lit(1)).alias("rows"))
