"""Times the headline queries; prints one JSON line.

Every query's result is consumed in full by a sink that discards it. A query is run once
to warm up and then timed; the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import time

from tablepull.plans.queries import QUERIES
from tablepull.session import local_session

HEADLINES = (
    "sql_join_group",
    "table_scan",
    "incr_ge_timestamp",
    "topk_limit",
    "topk_limit_large",
    "increment_health",
    "two_step_increment",
    "load_upsert",
    "load_upsert_partitioned",
    "key_violations",
    "column_profile",
    "column_profile_one_pass",
    "text_render",
    "csv_roundtrip",
    "export_counts",
    "catalog_tables",
    "catalog_columns",
    "catalog_nested",
    "manifest_classic_json",
    "stream_ingest",
    "sql_range_join",
    "sql_rank",
    "sql_running_sum",
    "sql_distinct_agg",
    "sql_rollup",
    "manifest_columns",
    "manifest_typed_json",
    "catalog_whitelist_independent",
    "csv_lines",
    "csv_arity",
    "csv_roundtrip_html",
    "column_profile_documents",
    "load_upsert_stored",
    "export_and_load",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINES:
        run(spark, name, sf_dir)
        times[name] = round(min(run(spark, name, sf_dir) for _ in range(2)), 3)
    total = round(sum(times.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
