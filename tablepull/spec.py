"""What to export: one ``TableSpec`` per output table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any


class SpecError(ValueError):
    """The request itself is wrong: an unknown column, a contradiction, bad data."""


@dataclass(frozen=True)
class TableSpec:
    """A table (or a query) to export, and how its output is to be loaded."""

    output_table: str
    query: str | None = None
    schema: str | None = None
    table: str | None = None
    columns: tuple[str, ...] = ()
    increment_column: str | None = None
    increment_limit: int | None = None
    tie_break: tuple[str, ...] = ()
    incremental: bool = False
    primary_key: tuple[str, ...] = ()
    enabled: bool = True
    id: int | None = None
    name: str | None = None
    bool_style: str = "tf"
    batch_size: int = 10_000
    partition_column: str | None = None
    partitions: int = 1

    def __post_init__(self) -> None:
        if bool(self.query) == bool(self.table):
            raise SpecError("Give either a query or a table, not both.")
        if self.query and self.increment_column:
            raise SpecError("Incremental fetching is not supported for queries.")
        if self.query and self.columns:
            raise SpecError("A query selects its own columns.")
        if self.increment_limit is not None and self.increment_limit < 0:
            raise SpecError("The increment limit must not be negative.")
        if self.increment_column and self.columns and self.increment_column not in self.columns:
            raise SpecError(f'The increment column "{self.increment_column}" is not among the exported columns.')
        if self.batch_size < 1:
            raise SpecError("The batch size must be positive.")
        if self.partitions < 1:
            raise SpecError("The number of partitions must be positive.")
        if self.partitions > 1 and not self.partition_column:
            raise SpecError("A read in several partitions needs a partition column.")
        if self.partition_column and self.query:
            raise SpecError("A query is read in one partition.")

    @classmethod
    def from_config(cls, row: Mapping[str, Any]) -> TableSpec:
        """Reads one entry of a job configuration.

        Old configurations may carry a limit without a column (ignored) and empty
        strings among the key columns (dropped).
        """
        query = row.get("query") or None
        source = row.get("table") or {}
        if not query and not (source.get("schema") and source.get("tableName")):
            raise SpecError('Either "query" or "table" with "schema" and "tableName" is required.')
        column = row.get("incrementalFetchingColumn") or None
        fallback = bool(row.get("forceFallback", False))
        consistent = bool(row.get("useConsistentFallbackBooleanStyle", False))
        return cls(
            output_table=row.get("outputTable") or row.get("name") or source.get("tableName") or "",
            query=query,
            schema=None if query else source["schema"],
            table=None if query else source["tableName"],
            columns=() if query else tuple(row.get("columns") or ()),
            increment_column=column,
            increment_limit=(row.get("incrementalFetchingLimit") or None) if column else None,
            incremental=bool(row.get("incremental", False)),
            primary_key=tuple(key for key in row.get("primaryKey") or () if key != ""),
            enabled=bool(row.get("enabled", True)),
            id=row.get("id"),
            name=row.get("name"),
            bool_style="10" if fallback and not consistent else "tf",
            batch_size=int(row.get("batchSize") or 10_000),
            partition_column=row.get("partitionColumn") or None,
            partitions=int(row.get("partitions") or 1),
        )


def specs_from_config(parameters: Mapping[str, Any]) -> list[TableSpec]:
    """The specs of a job: the list form (``tables``) or the single-row form."""
    rows = parameters["tables"] if "tables" in parameters else [parameters]
    return [TableSpec.from_config(row) for row in rows]
