"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepull.functions.names import project, sanitize_columns
from tablepull.functions.render import render_bool, render_text
from tablepull.operators.asof import asof_join
from tablepull.operators.catalog import first_column, list_columns, list_tables, nest_columns, pk_flags, with_defaults
from tablepull.operators.increment import (
    bounded_increment,
    increment_health,
    last_watermark,
    max_watermark,
    read_mark,
    run_increment,
    since,
)
from tablepull.operators.keys import first_per_key, key_violations
from tablepull.operators.late import late_increment
from tablepull.operators.load import appended, load, load_spec, replaced, upserted
from tablepull.operators.manifest import manifest_documents, manifest_entries, typed_columns
from tablepull.operators.overlap import overlap_join
from tablepull.operators.pruned import read_target, upsert_pruned
from tablepull.operators.profile import APPROX_ERROR, column_profile, column_profile_approx
from tablepull.operators.sinks import check_arity, csv_lines, read_csv, write_csv
from tablepull.operators.sketches import DISTINCT_ERROR, FREQUENT_ERROR, RANK_ERROR, append_sketches, profile_from_sketches
from tablepull.operators.snapshots import leaf_bits, snapshot_diff, write_digests
from tablepull.operators.toplimit import limit_batch
from tablepull.plans.acceptance import ACCEPTANCE, VIEWS
from tablepull.plans.estate import estate, estate_targets
from tablepull.plans.run import run_job, run_specs, table_counts
from tablepull.session import remove_path, shared_dir, with_session
from tablepull.sources.csv_split import read_csv_split
from tablepull.sources.scan import even_cuts, parquet_tables, scan_query, scan_table, stride_counts
from tablepull.spec import TableSpec
from tablepull.streaming.ingest import ingest_new, ingested
from tablepull.streaming.sessions import closed_sessions, open_sessions, session_new
from tablepull.streaming.upsert import upsert_new
from tablepull.streaming.windows import closed_windows, late_rows, open_windows, window_new

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Registers a function; a trailing underscore only keeps its name apart from an operator's."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return parquet_tables(spark, sf_dir)("main", name)


# Sources


@query
def table_scan(spark, sf_dir):
    spec = TableSpec(output_table="orders", schema="main", table="orders")
    return scan_table(parquet_tables(spark, sf_dir), spec)


@query
def query_scan(spark, sf_dir):
    text = 'SELECT\n  c_custkey,\n  c_name, "c_acctbal"\nFROM\n  customer; ;'
    return scan_query(spark, text, {"customer": table(spark, sf_dir, "customer")})


@query
def range_split_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return stride_counts(orders, "o_orderkey", even_cuts(low, high, 8))


@query
def init_timezone_days(spark, sf_dir):
    session = with_session(spark, init=["SET TIME ZONE 'Asia/Manila'"])
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts"))
    days = table(session, sf_dir, "events").select(F.to_date(local).cast("string").alias("day"))
    return days.groupBy("day").agg(F.count(F.lit(1)).alias("events"))


def _specs() -> list[TableSpec]:
    wanted = {"orders": True, "lineitem": True, "customer": True, "events": True, "documents": True, "part": False}
    specs = [TableSpec(output_table=t, schema="main", table=t, enabled=on) for t, on in wanted.items()]
    return [*specs, TableSpec(output_table="order_customers", query="SELECT DISTINCT o_custkey FROM orders;")]


@query
def multi_table_counts(spark, sf_dir):
    views = {"orders": table(spark, sf_dir, "orders")}
    return table_counts(spark, _specs(), parquet_tables(spark, sf_dir), views)


# Projection, names, increments


@query
def project_columns(spark, sf_dir):
    return project(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_custkey", "c_acctbal"])


@query
def incr_ge_int(spark, sf_dir):
    return since(table(spark, sf_dir, "orders"), "o_orderkey", "12000")


@query
def incr_ge_numeric(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return since(lines, "l_extendedprice", "50000.00")


@query
def incr_ge_timestamp(spark, sf_dir):
    return since(table(spark, sf_dir, "events"), "ts", "2024-01-20 00:00:00")


@query
def bounded_increment_(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    high = read_mark(max_watermark(events, "ts"))
    return bounded_increment(events, "ts", "2024-01-10 00:00:00", high)


def _awkward(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.toDF("_Weir%d I-D", "Weir%d Na-me", "some.Integer", "some`Decimal", "type")


@query
def quoted_identifiers(spark, sf_dir):
    view = {"auto Increment Timestamp": _awkward(spark, sf_dir)}
    rows = scan_query(spark, 'SELECT * FROM "auto Increment Timestamp";', view)
    return project(since(rows, "_Weir%d I-D", "0"), ["some`Decimal", "some.Integer", "Weir%d Na-me", "_Weir%d I-D"])


@query
def sanitize_columns_(spark, sf_dir):
    return sanitize_columns(_awkward(spark, sf_dir))


@query
def watermark_max(spark, sf_dir):
    return max_watermark(table(spark, sf_dir, "events"), "ts")


@query
def watermark_last(spark, sf_dir):
    return last_watermark(limit_batch(table(spark, sf_dir, "events"), "ts", 500), "ts")


@query
def topk_limit(spark, sf_dir):
    return limit_batch(table(spark, sf_dir, "events"), "ts", 500, ("event_id",))


@query
def topk_limit_ties(spark, sf_dir):
    """Ties and no tie-break, at two limits about the heap's size: rows kept of each day."""
    lines = table(spark, sf_dir, "lineitem")
    kept = [limit_batch(lines, "l_shipdate", n).groupBy(F.col("l_shipdate").alias("day")).agg(F.count(F.lit(1)).alias(name)) for n, name in ((9_999, "kept_small"), (10_001, "kept_large"))]
    return kept[0].join(kept[1], "day", "full")


@query
def topk_limit_large(spark, sf_dir):
    """A limit too large for one task: two thirds of the rows, ties by all other columns."""
    lines = table(spark, sf_dir, "lineitem")
    others = tuple(name for name in lines.columns if name != "l_shipdate")
    return limit_batch(lines, "l_shipdate", lines.count() * 2 // 3, others, heap_rows=1_000)


@query
def two_step_increment(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    _, state = run_increment(events, "event_id", None, 1000)
    batch, _ = run_increment(events, "event_id", state, 1000)
    return batch


@query
def increment_health_(spark, sf_dir):
    return increment_health(table(spark, sf_dir, "lineitem"), "l_shipdate")


# When an event arrives: one in ten comes a day and a half late.
ARRIVAL = "ts + CASE WHEN event_id % 10 = 3 THEN INTERVAL '36' HOUR ELSE INTERVAL '0' HOUR END"
RUNS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00", "2024-03-01 00:00:00")


@query
def late_increment_(spark, sf_dir):
    """Three runs over a table that grows, in which rows appear below marks already passed; which run brought which row."""
    path, events, brought = shared_dir(spark, "late-state"), table(spark, sf_dir, "events"), []
    for number, until in enumerate(RUNS, 1):
        there = events.filter(F.expr(ARRIVAL) < F.lit(until).cast("timestamp_ntz"))
        run = late_increment(there, "ts", ["event_id"], path, "2 days")
        run.commit()
        brought.append(run.batch.select("event_id", "ts", F.lit(number).alias("run")))
    return brought[0].unionByName(brought[1]).unionByName(brought[2])


# Text, CSV


@query
def bool_tf(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", render_bool(F.col("o_totalprice") > 100000).alias("large"))


@query
def bool_10(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", render_bool(F.col("o_totalprice") > 100000, "10").alias("large"))


@query
def text_render(spark, sf_dir):
    return render_text(table(spark, sf_dir, "orders"))


@query
def text_render_decimal(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return render_text(
        lines.select(
            "l_orderkey",
            "l_linenumber",
            F.col("l_extendedprice").cast("decimal(12,3)").alias("price"),
            (F.col("l_discount") > F.col("l_tax")).alias("discounted"),
            F.col("l_shipdate").cast("date").alias("shipped"),
        )
    )


@query
def csv_lines_(spark, sf_dir):
    return csv_lines(table(spark, sf_dir, "documents"))


def _roundtrip(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    path = shared_dir(spark, purpose)
    write_csv(df, path)
    return read_csv(spark, path, df.columns)


@query
def csv_roundtrip(spark, sf_dir):
    return _roundtrip(spark, table(spark, sf_dir, "documents"), "csv-documents")


@query
def csv_roundtrip_html(spark, sf_dir):
    return _roundtrip(spark, table(spark, sf_dir, "pages"), "csv-pages")


@query
def csv_roundtrip_one_column(spark, sf_dir):
    """One column only: a NULL is an empty line, an empty text is two quotes."""
    turns = table(spark, sf_dir, "conversations")
    role = F.when(F.col("role") == "user", F.lit("")).when(F.col("role") != "assistant", F.concat("role", F.lit('\n"'), "text"))
    return _roundtrip(spark, turns.select(role.alias("role")), "csv-one")


@query
def csv_roundtrip_nulls(spark, sf_dir):
    """NULL and empty text stay apart: roles by turn, one of them NULL, one empty."""
    turns = table(spark, sf_dir, "conversations")
    role = F.when(F.col("role") == "user", F.lit("")).when(F.col("role") != "assistant", F.col("role"))
    return _roundtrip(spark, turns.withColumn("role", role), "csv-nulls")


@query
def csv_split_read(spark, sf_dir):
    """All documents in one file, whose values hold line breaks, read by many tasks with their types."""
    documents, path = table(spark, sf_dir, "documents"), shared_dir(spark, "csv-split-read")
    write_csv(documents, path, records_per_file=0, single_file=True)
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = {"spark.sql.files.maxPartitionBytes": str(min(128 << 20, max(1 << 16, size // 16))), "spark.sql.files.openCostInBytes": "4096"}
    return read_csv_split(with_session(spark, ranges), path, documents.schema)


@query
def csv_arity(spark, sf_dir):
    path = shared_dir(spark, "csv-arity")
    documents = table(spark, sf_dir, "documents")
    write_csv(documents, path)
    files = check_arity(spark, path, documents.columns)
    return files.agg(*[F.sum(name).alias(name) for name in ("records", "bad_records", "blank_records")])


@query
def export_counts(spark, sf_dir):
    views = {"orders": table(spark, sf_dir, "orders")}
    out = shared_dir(spark, "export")
    results = run_specs(spark, _specs(), parquet_tables(spark, sf_dir), out, views=views)
    remove_path(spark, out)
    return spark.createDataFrame([(r.output_table, r.rows) for r in results], "table_name string, rows long")


@query
def export_increment(spark, sf_dir):
    """Two runs of a job by configuration: the second one starts from the first one's state."""
    out = shared_dir(spark, "increment")
    spec = TableSpec.from_config(
        {
            "outputTable": "events",
            "table": {"schema": "main", "tableName": "events"},
            "columns": ["event_id", "ts", "event_type", "value"],
            "incremental": True,
            "primaryKey": ["event_id", ""],
            "incrementalFetchingColumn": "ts",
            "incrementalFetchingLimit": 2000,
        }
    )
    tables = parquet_tables(spark, sf_dir)
    first = run_specs(spark, [spec], tables, f"{out}/1")[0]
    run_specs(spark, [spec], tables, f"{out}/2", states={"events": first.state})
    return read_csv(spark, f"{out}/2/events.csv", list(spec.columns))


@query
def export_and_load(spark, sf_dir):
    """Two runs of a job by configuration; the flags of its spec say how each enters the target: by key."""
    out = shared_dir(spark, "export-and-load")
    row = {
        "outputTable": "events",
        "table": {"schema": "main", "tableName": "events"},
        "columns": ["event_id", "ts", "event_type", "value"],
        "incremental": True,
        "primaryKey": ["event_id"],
        "incrementalFetchingColumn": "ts",
        "incrementalFetchingLimit": 2000,
    }
    job = {"tables": [row], "initQueries": ["SET TIME ZONE 'UTC'"], "dataTypeSupport": "authoritative"}
    spec, states = TableSpec.from_config(row), {}
    for run in (1, 2):
        result = run_job(spark, job, lambda session: parquet_tables(session, sf_dir), f"{out}/{run}", states)[0]
        states = {"events": result.state}
        load_spec(spark, spec, read_csv(spark, f"{out}/{run}/events.csv", list(spec.columns)), f"{out}/target")
    return spark.read.parquet(f"{out}/target")


@query
def caught_up_increment(spark, sf_dir):
    """A limited run on a table without new rows sends the row of its state again and keeps the state."""
    events = table(spark, sf_dir, "events")
    last = read_mark(max_watermark(events, "event_id"))
    batch, state = run_increment(events, "event_id", last, 1)
    return batch.select("event_id", F.lit(state).alias("state"))


# Load modes and keys


def _base_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders up to 1998, and a later pull that re-sends 1997 with changed prices, twice."""
    orders = table(spark, sf_dir, "orders")
    base = orders.filter("o_orderdate < timestamp_ntz'1998-01-01 00:00:00'")
    pull = orders.filter("o_orderdate >= timestamp_ntz'1997-01-01 00:00:00'")
    older = pull.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return base, older.unionByName(pull.withColumn("o_totalprice", F.col("o_totalprice") + 2))


@query
def load_replace(spark, sf_dir):
    return replaced(*_base_and_batch(spark, sf_dir))


@query
def load_append(spark, sf_dir):
    return appended(*_base_and_batch(spark, sf_dir))


@query
def load_upsert(spark, sf_dir):
    base, batch = _base_and_batch(spark, sf_dir)
    return upserted(base, batch, ["o_orderkey"], [F.col("o_totalprice").desc()])


@query
def load_upsert_stored(spark, sf_dir):
    base, batch = _base_and_batch(spark, sf_dir)
    path = shared_dir(spark, "target")
    load(spark, base, path, "replace")
    load(spark, batch, path, "upsert", ["o_orderkey"], [F.col("o_totalprice").desc()])
    return spark.read.parquet(path)


@query
def load_append_stored(spark, sf_dir):
    base, batch = _base_and_batch(spark, sf_dir)
    path = shared_dir(spark, "target")
    load(spark, base, path, "replace")
    load(spark, batch.select(*reversed(batch.columns)), path, "append")
    return spark.read.parquet(path)


@query
def load_upsert_partitioned(spark, sf_dir):
    """The same through stored tables: only the partitions the batch touches are rewritten."""
    base, batch = [
        df.withColumn("o_year", F.year("o_orderdate")) for df in _base_and_batch(spark, sf_dir)
    ]
    path = shared_dir(spark, "target")
    load(spark, base, path, "replace", partition_by=["o_year"])
    load(spark, batch, path, "upsert", ["o_year", "o_orderkey"], [F.col("o_totalprice").desc()], ["o_year"])
    return spark.read.parquet(path)


@query
def load_upsert_pruned(spark, sf_dir):
    """The last fifth of the keys is pulled again, twice, with changed prices; the files of the others are left alone."""
    orders = table(spark, sf_dir, "orders")
    rows, high = orders.agg(F.count(F.lit(1)), F.max("o_orderkey")).first()
    base = orders.filter(F.col("o_orderkey") * 10 < 9 * high)
    pull = orders.filter(F.col("o_orderkey") * 10 >= 8 * high)
    batch = pull.withColumn("o_totalprice", F.col("o_totalprice") + 1).unionByName(pull.withColumn("o_totalprice", F.col("o_totalprice") + 2))
    path, size = shared_dir(spark, "pruned"), min(1_000_000, rows // 8)
    upsert_pruned(spark, base, path, ["o_orderkey"], rows_per_file=size)
    upsert_pruned(spark, batch, path, ["o_orderkey"], [F.col("o_totalprice").desc()], rows_per_file=size)
    return read_target(spark, path)


@query
def snapshot_diff_(spark, sf_dir):
    """Two versions of the orders: a fiftieth of the keys deleted, another one changed, some added beyond the last."""
    orders = table(spark, sf_dir, "orders")
    high = orders.agg(F.max("o_orderkey")).first()[0]
    share = lambda low, top: (F.col("o_orderkey") * 50 >= low * high) & (F.col("o_orderkey") * 50 < top * high)
    changed = orders.filter(~share(20, 21)).withColumn("o_totalprice", F.col("o_totalprice") + F.when(share(30, 31), 1).otherwise(0))
    added = orders.filter(share(0, 1)).withColumn("o_orderkey", F.col("o_orderkey") + high + 1)
    base, keys = shared_dir(spark, "snapshots"), ["o_orderkey"]
    bits = leaf_bits(orders, keys, 1_000)
    for name, version in (("1", orders), ("2", changed.unionByName(added))):
        version.write.parquet(f"{base}/{name}")
        write_digests(spark.read.parquet(f"{base}/{name}"), keys, f"{base}/digests-{name}", bits)
    old, new = (spark.read.parquet(f"{base}/{name}") for name in "12")
    return snapshot_diff(old, new, keys, f"{base}/digests-1", f"{base}/digests-2", bits)


@query
def key_violations_(spark, sf_dir):
    return key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def first_per_key_events(spark, sf_dir):
    latest = [F.col("ts").desc(), F.col("event_id")]
    return first_per_key(table(spark, sf_dir, "events"), ["event_type"], latest)


# Joins in time


@query
def asof_join_events(spark, sf_dir):
    """Each event with the last earlier event of another type of its user."""
    events = table(spark, sf_dir, "events")
    types = F.array(*[F.lit(row[0]) for row in events.select("event_type").distinct().collect()])
    others = events.select("user_id", F.explode(F.array_remove(types, F.col("event_type"))).alias("event_type"), "ts", "event_id", "value")
    brought = {"event_id": "last_id", "ts": "last_ts", "value": "last_value"}
    rows = max(1_000, events.count() // 8)
    return asof_join(events.drop("props"), others, ["user_id", "event_type"], "ts", "ts", brought, strict=True, part_rows=min(1_000_000, rows))


@query
def overlap_join_(spark, sf_dir):
    """Errors and views of a user as intervals of one second to the whole table; pairs that share a moment."""
    events = table(spark, sf_dir, "events")
    sides = []
    for kind in ("error", "view"):
        seconds = F.expr("make_dt_interval(0, 0, 0, cast(shiftleft(1L, cast(event_id % 22 as int)) as decimal(18, 6)))")
        sides.append(events.filter(F.col("event_type") == kind).select("user_id", "event_id", F.col("ts").alias("since"), (F.col("ts") + seconds).alias("until")))
    names = [{"user_id": "user_id", "event_id": "error_id"}, {"event_id": "view_id"}]
    return overlap_join(*sides, ["user_id"], ("since", "until"), ("since", "until"), *names)


# Catalogue and manifests


@query
def catalog_tables(spark, sf_dir):
    return list_tables(estate(spark, sf_dir))


@query
def catalog_columns(spark, sf_dir):
    return list_columns(estate(spark, sf_dir))


@query
def catalog_system_columns(spark, sf_dir):
    return list_columns(estate(spark, sf_dir), system=True)


def _wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of urgent orders, as (schema, table) pairs."""
    catalog = estate(spark, sf_dir)
    views = list_tables(catalog, ordered=False)
    return views.filter("table_type = 'view'").select("table_schema", "table_name")


@query
def catalog_whitelist(spark, sf_dir):
    return list_columns(estate(spark, sf_dir), only=_wanted(spark, sf_dir))


@query
def catalog_whitelist_independent(spark, sf_dir):
    return list_columns(estate(spark, sf_dir), only=_wanted(spark, sf_dir), pairwise=False)


@query
def catalog_defaults(spark, sf_dir):
    catalog = estate(spark, sf_dir)
    return with_defaults(catalog.attribute, catalog.attrdef)


@query
def catalog_pk_flags(spark, sf_dir):
    catalog = estate(spark, sf_dir)
    return pk_flags(catalog.attribute, catalog.index)


@query
def catalog_dedup(spark, sf_dir):
    listed = list_columns(estate(spark, sf_dir), ordered=False, dedup=False)
    return first_column(listed).select("table_schema", "table_name", "column_name", "ordinal_position", "data_type")


@query
def catalog_nested(spark, sf_dir):
    nested = nest_columns(list_columns(estate(spark, sf_dir), ordered=False))
    return nested.select("table_schema", "table_name", "table_type", F.to_json("columns").alias("columns"))


@query
def manifest_columns(spark, sf_dir):
    catalog = estate(spark, sf_dir)
    return manifest_entries(list_columns(catalog, ordered=False), estate_targets(catalog))


@query
def manifest_typed(spark, sf_dir):
    catalog = estate(spark, sf_dir)
    return typed_columns(list_columns(catalog, ordered=False), estate_targets(catalog))


@query
def manifest_classic_json(spark, sf_dir):
    catalog = estate(spark, sf_dir)
    return manifest_documents(list_columns(catalog, ordered=False), estate_targets(catalog))


@query
def manifest_typed_json(spark, sf_dir):
    catalog = estate(spark, sf_dir)
    return manifest_documents(list_columns(catalog, ordered=False), estate_targets(catalog), typed=True)


@query
def column_profile_(spark, sf_dir):
    return column_profile(table(spark, sf_dir, "lineitem"))


@query
def column_profile_documents(spark, sf_dir):
    return column_profile(table(spark, sf_dir, "documents"))


@query
def column_profile_one_pass(spark, sf_dir):
    """The one-pass form; ``near`` says whether an estimated distinct count is within three times the stated error."""
    lines = table(spark, sf_dir, "lineitem")
    exact = column_profile(lines).select("column_name", F.col("distinct_values").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.greatest(F.lit(1), 3 * APPROX_ERROR * F.col("exact"))
    return column_profile_approx(lines).join(exact, "column_name").withColumn("near", near).drop("distinct_values", "exact")


@query
def profile_from_sketches_(spark, sf_dir):
    """The profile merged from three increments, which are read once each.

    ``near`` holds an estimated distinct count within three times its stated error, ``near_ranks`` the quantiles and
    ``near_counts`` the most frequent value's count within theirs (a column may have no frequent value).
    """
    lines, path = table(spark, sf_dir, "lineitem"), shared_dir(spark, "sketches")
    year = F.year("l_shipdate")
    for part in (lines.filter(year < 1997), lines.filter(year == 1997), lines.filter((year > 1997) | year.isNull())):
        append_sketches(part, path)
    profile = profile_from_sketches(spark, path)
    exact = column_profile(lines).select("column_name", F.col("distinct_values").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.greatest(F.lit(1), 3 * DISTINCT_ERROR * F.col("exact"))
    found, checks = profile.select("column_name", "quantiles", "frequent").collect(), []
    for row in found:
        value, held = F.col(row["column_name"]), F.lit(True)
        for top in row["frequent"][:1]:
            counted = F.count_if(value.cast("string") == top["value"])
            held = F.abs(counted - F.lit(top["n"])) <= F.count(F.lit(1)) * FREQUENT_ERROR + 1
        ranks = [(F.count_if(value < q) <= (share + RANK_ERROR) * F.count(value)) & (F.count_if(value <= q) >= (share - RANK_ERROR) * F.count(value)) for q, share in zip(row["quantiles"] or [], (0.25, 0.5, 0.75))]
        both = (ranks[0] & ranks[1] & ranks[2]) if ranks else F.lit(None).cast("boolean")
        checks.append(F.struct(F.lit(row["column_name"]).alias("column_name"), both.alias("near_ranks"), held.alias("near_counts")))
    checked = lines.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))
    return profile.drop("quantiles", "frequent").join(exact, "column_name").join(checked, "column_name").withColumn("near", near).drop("distinct_values", "exact")


# Streaming


@query
def stream_ingest(spark, sf_dir):
    """Events land in two deliveries; each run takes what is new."""
    base = shared_dir(spark, "stream")
    events = table(spark, sf_dir, "events")
    middle = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    for delivery in (events.filter(F.col("ts") >= middle), events.filter(F.col("ts") < middle)):
        delivery.write.mode("append").parquet(f"{base}/in")
        ingest_new(spark, f"{base}/in", events.schema, f"{base}/checkpoint", f"{base}/out")
    return ingested(spark, f"{base}/out", events.schema)


@query
def stream_upsert(spark, sf_dir):
    """Three deliveries that overlap; each re-sends ids with another value, the last one all its rows twice."""
    base, events = shared_dir(spark, "stream-upsert"), table(spark, sf_dir, "events")
    day = lambda d: F.lit(f"2024-01-{d} 00:00:00").cast("timestamp_ntz")
    deliveries = (("01", "13", 0), ("09", "22", 1), ("18", "31", 2))
    for low, high, plus in deliveries:
        part = events.filter((F.col("ts") >= day(low)) & (F.col("ts") < day(high)))
        sent = part.withColumn("value", F.col("value") + plus)
        if plus == 2:
            sent = sent.unionByName(part.withColumn("value", F.col("value") - 1))
        sent.write.mode("append").parquet(f"{base}/in")
        upsert_new(spark, f"{base}/in", events.schema, f"{base}/checkpoint", f"{base}/target", ["event_id"], [F.col("value").desc()])
    return read_target(spark, f"{base}/target")


def _deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Events as they arrive, in three deliveries."""
    events, since = table(spark, sf_dir, "events"), [None, *RUNS[:-1]]
    at = [None if t is None else F.lit(t).cast("timestamp_ntz") for t in (*since, None)]
    out = []
    for low, high in zip(at, at[1:]):
        part = events if low is None else events.filter(F.expr(ARRIVAL) >= low)
        out.append(part if high is None else part.filter(F.expr(ARRIVAL) < high))
    return out


@query
def stream_windows(spark, sf_dir):
    """Events by type and six hours, of three deliveries with late rows: rows in windows, closed or open, and rows too late for theirs."""
    base, keys = shared_dir(spark, "stream-windows"), ["event_type"]
    schema = table(spark, sf_dir, "events").schema
    for delivery in _deliveries(spark, sf_dir):
        delivery.write.mode("append").parquet(f"{base}/in")
        window_new(spark, f"{base}/in", schema, base, "ts", keys, "value", "6 hours", "12 hours")
    counted = closed_windows(spark, base, schema, keys, "value").unionByName(open_windows(spark, base, keys))
    late = late_rows(spark, base, schema).groupBy(F.window("ts", "6 hours").getField("start").cast("timestamp").alias("window_start"), "event_type")
    late = late.agg(F.count(F.lit(1)).alias("n_late"))
    both = counted.join(late, ["window_start", "event_type"], "full").fillna(0, ["n", "n_late"])
    return both.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query
def stream_sessions(spark, sf_dir):
    """Sessions of a user and type with gaps below a day, of three deliveries with rows out of order: those that are over and those still open."""
    base, keys = shared_dir(spark, "stream-sessions"), ["user_id", "event_type"]
    schema = table(spark, sf_dir, "events").schema
    for delivery in _deliveries(spark, sf_dir):
        delivery.write.mode("append").parquet(f"{base}/in")
        session_new(spark, f"{base}/in", schema, base, keys, "ts", 24 * 3600, "2 days")
    both = closed_sessions(spark, base, schema, keys).unionByName(open_sessions(spark, base, keys))
    return both.withColumns({name: F.col(name).cast("timestamp_ntz") for name in ("session_start", "session_end")})


# Queries as users write them


def _acceptance(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        views = {view: table(spark, sf_dir, view) for view in VIEWS if view in ACCEPTANCE[name]}
        return scan_query(spark, ACCEPTANCE[name], views)

    return run


for _name in ACCEPTANCE:
    QUERIES[_name] = _acceptance(_name)
