"""Runs a query and its SQL counterpart and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def canonical(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (decimal.Decimal, float)):
        return repr(float(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    return value


def rows_of(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(canonical(row[i]) for i in order) for row in rows)


def kind(type_name: str) -> str:
    """A coarse type, equal for both engines."""
    text = type_name.lower()
    names = {"varchar": "string", "integer": "int", "hugeint": "HUGEINT", "timestamp": "timestamp_ntz", "tinyint": "tinyint"}
    return "decimal" if text.startswith("decimal") else names.get(text, text)


def differences(df, connection, sql: str) -> list[str]:
    names, mine = rows_of(df.columns, [tuple(row) for row in df.collect()])
    relation = connection.sql(sql)
    other_names, other = rows_of(relation.columns, relation.fetchall())
    found = []
    if names != other_names:
        return [f"columns {names} != {other_names}"]
    types = {name: kind(t) for name, t in df.dtypes}
    other_types = {name: kind(str(t)) for name, t in zip(relation.columns, relation.types)}
    if types != other_types:
        found.append("types " + str({n: (types[n], other_types[n]) for n in names if types[n] != other_types[n]}))
    if mine != other:
        found.append(f"rows {sum(mine.values())} / {sum(other.values())}")
        found += [f"only here: {row}" for row in list((mine - other).keys())[:3]]
        found += [f"only there: {row}" for row in list((other - mine).keys())[:3]]
    return found
