"""A job: every enabled spec is scanned, exported, described, and its state kept."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepull.functions.names import sanitize_names
from tablepull.messages import EMPTY_RESULT
from tablepull.operators.catalog import listing_of
from tablepull.operators.increment import increment_type, plan_increment
from tablepull.operators.keys import check_keys
from tablepull.operators.manifest import manifest_documents, targets_of
from tablepull.operators.sinks import write_csv, write_document
from tablepull.session import with_session
from tablepull.sources.scan import Resolver, scan_query, scan_table, sized
from tablepull.spec import SpecError, TableSpec, specs_from_config

STATE_KEY = "lastFetchedRow"


@dataclass(frozen=True)
class TableResult:
    output_table: str
    rows: int
    state: dict[str, str]
    warning: str | None


def source_of(spark: SparkSession, spec: TableSpec, resolve: Resolver, views: Mapping[str, DataFrame]) -> DataFrame:
    return scan_query(spark, spec.query, views) if spec.query else scan_table(resolve, spec)


def export_table(spark: SparkSession, spec: TableSpec, df: DataFrame, out_dir: str, state: Mapping[str, str] | None = None, manifest: str | None = None) -> TableResult:
    """Exports one table to ``<out_dir>/<output table>.csv``, then its manifest, and its new state last.

    A job that fails on the way leaves no state, so the next run starts where this one did.
    Rows and mark are counted by the job that writes the files. An empty increment keeps
    the old state and writes neither files nor a state.
    """
    sanitize_names(df.columns)
    old = (state or {}).get(STATE_KEY) if spec.increment_column else None
    batch = df
    if spec.increment_column:
        batch = plan_increment(df, spec.increment_column, old, spec.increment_limit, spec.tie_break).batch

    path = f"{out_dir.rstrip('/')}/{spec.output_table}"
    result = write_csv(batch, f"{path}.csv", spec.increment_column, spec.bool_style)
    if manifest is not None:
        write_document(spark, manifest, f"{path}.csv.manifest")
    new = dict(state or {})
    if result.last_value is not None:
        new[STATE_KEY] = result.last_value
        write_document(spark, new, f"{path}.state.json")
    warning = None if result.rows else EMPTY_RESULT.format(table=spec.output_table)
    return TableResult(spec.output_table, result.rows, new, warning)


def describe(spark: SparkSession, sources: Mapping[TableSpec, DataFrame], listing: DataFrame | None = None, typed: bool = False, prefix: str = "") -> dict[str, str]:
    """The manifests of some exports as JSON texts, by output table.

    ``listing`` describes the sources where a catalogue exists; the schemas of the frames
    are used otherwise, and for queries always.
    """
    manifests: dict[str, str] = {}
    for query_form in (False, True):
        specs = [spec for spec in sources if bool(spec.query) == query_form]
        if not specs:
            continue
        rows = manifest_documents(_described(spark, specs, sources, None if query_form else listing), targets_of(spark, specs), typed, query_form, prefix)
        manifests.update({row["destination"]: row["manifest"] for row in rows.collect()})
    missing = [spec.output_table for spec in sources if spec.output_table not in manifests]
    if missing:
        raise SpecError(f'The table of "{missing[0]}" was not found in the catalogue.')
    return manifests


def _described(spark: SparkSession, specs: list[TableSpec], sources: Mapping[TableSpec, DataFrame], listing: DataFrame | None) -> DataFrame:
    """The columns of all exports: the listing is joined once, however many specs there are."""
    named = {spec: (spec.schema or "", spec.table or spec.output_table) for spec in specs}
    if listing is None:
        # Positions are those of the source, of which the frame may be a projection.
        listing = listing_of(spark, {named[spec]: sources[spec] for spec in specs}, {named[spec] for spec in specs if spec.query})
    wanted = [(*named[spec], spec.output_table, list(spec.columns)) for spec in specs]
    targets = spark.createDataFrame(wanted, "table_schema string, table_name string, destination string, exported array<string>")
    rows = listing.join(F.broadcast(targets), ["table_schema", "table_name"])
    # The lists follow the exported order; the positions stay the source's own.
    place = F.array_position("exported", F.col("column_name")).cast("int")
    rows = rows.withColumn("export_position", F.when(F.size("exported") == 0, F.col("ordinal_position")).otherwise(place))
    return rows.filter(F.col("export_position") != 0).drop("exported")


def run_specs(spark: SparkSession, specs: Iterable[TableSpec], resolve: Resolver, out_dir: str, states: Mapping[str, Mapping[str, str]] | None = None, views: Mapping[str, DataFrame] | None = None, listing: DataFrame | None = None, typed: bool = False, prefix: str = "", parallel: int = 4) -> list[TableResult]:
    """Exports all enabled specs. The jobs are independent, so some run side by side.

    All requests are checked before the first row is read.
    """
    enabled = [spec for spec in specs if spec.enabled]
    names = [spec.output_table for spec in enabled]
    if len(set(names)) < len(names):
        raise SpecError("Two specs write to one output table.")
    sources = {spec: source_of(spark, spec, resolve, views or {}) for spec in enabled}
    # Described from the whole table: positions are those of the source.
    whole = {spec: df if spec.query else sized(resolve, spec)(spec.schema, spec.table) for spec, df in sources.items()}
    for spec, df in sources.items():
        clean = sanitize_names(df.columns)
        if spec.primary_key:
            check_keys(df if set(spec.primary_key) <= set(df.columns) else df.toDF(*clean), spec.primary_key)
        if spec.increment_column:
            increment_type(df, spec.increment_column)

    manifests = describe(spark, whole, listing, typed, prefix)

    def export(spec: TableSpec) -> TableResult:
        name = spec.output_table
        return export_table(spark, spec, sources[spec], out_dir, (states or {}).get(name), manifests[name])

    with ThreadPoolExecutor(max_workers=max(parallel, 1)) as pool:
        return list(pool.map(export, enabled))


def run_job(spark: SparkSession, parameters: Mapping[str, Any], tables: Callable[[SparkSession], Resolver], out_dir: str, states: Mapping[str, Mapping[str, str]] | None = None, listing: DataFrame | None = None, prefix: str = "") -> list[TableResult]:
    """Runs a job by its configuration: specs, ``initQueries`` and ``dataTypeSupport``.

    The init statements run in a session of the job's own; ``tables`` gives that session's
    tables. Every ``authoritative`` job writes typed manifests.
    """
    database = parameters.get("db") or {}
    own = with_session(spark, init=list(database.get("initQueries") or parameters.get("initQueries") or []))
    typed = (parameters.get("dataTypeSupport") or parameters.get("data_type_support")) == "authoritative"
    return run_specs(own, specs_from_config(parameters), tables(own), out_dir, states, listing=listing, typed=typed, prefix=prefix)


def table_counts(spark: SparkSession, specs: Iterable[TableSpec], resolve: Resolver, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Rows of every enabled spec, in one frame."""
    counts = [
        source_of(spark, spec, resolve, views or {})
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(spec.output_table).alias("table_name"), "rows")
        for spec in specs
        if spec.enabled
    ]
    if not counts:
        raise SpecError("No table is enabled.")
    total = counts[0]
    for count in counts[1:]:
        total = total.unionByName(count)
    return total


def result_frame(spark: SparkSession, results: Iterable[TableResult]) -> DataFrame:
    """The run's summary, one row per output table."""
    rows = [(r.output_table, r.rows, r.state.get(STATE_KEY), r.warning) for r in results]
    return spark.createDataFrame(rows, "table_name string, rows long, last_value string, warning string")
