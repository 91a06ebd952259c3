"""Column names: quoting and cleaning."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepull.spec import SpecError

# The rule that turns a source name into an output name.
NOT_ALPHANUMERIC = "[^A-Za-z0-9]+"
REPLACEMENT = "_"


def quoted(name: str) -> str:
    """``name`` as an SQL identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def qcol(name: str) -> Column:
    """The column called exactly ``name``; dots and blanks are not interpreted."""
    return F.col(quoted(name))


def sanitize_name(name: str) -> str:
    return re.sub(NOT_ALPHANUMERIC, REPLACEMENT, name).strip(REPLACEMENT)


def sanitized(column: Column) -> Column:
    """The same rule for names that are data, as in a catalogue listing."""
    return F.regexp_replace(F.regexp_replace(column, NOT_ALPHANUMERIC, REPLACEMENT), "^_+|_+$", "")


def sanitize_names(names: Iterable[str]) -> list[str]:
    """Clean names, refusing two sources that end up alike (letter case is ignored)."""
    result: list[str] = []
    owner: dict[str, str] = {}
    for name in names:
        clean = sanitize_name(name)
        if not clean:
            raise SpecError(f'Column "{name}" has no letter or digit.')
        if clean.lower() in owner:
            raise SpecError(f'Columns "{owner[clean.lower()]}" and "{name}" are both called "{clean}".')
        owner[clean.lower()] = name
        result.append(clean)
    return result


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*sanitize_names(df.columns))


def project(df: DataFrame, columns: Iterable[str] = ()) -> DataFrame:
    """The given columns in the given order; all of them if none is given."""
    wanted = list(columns)
    missing = [name for name in wanted if name not in df.columns]
    if missing:
        raise SpecError(f'Column "{missing[0]}" was not found in the table.')
    return df.select(*[qcol(name) for name in wanted]) if wanted else df
