"""A large catalogue derived from the order tables, to run the listing operators at scale.

Every order becomes a relation and every order line one of its columns, so the catalogue
grows with the data. Some relations are sequences or indexes, some schemas are system
schemas, some columns are dropped or system columns, and some lines name a column twice.
The texts are plain SQL; ``pair`` and ``single`` write an array of two or of one value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepull.functions.names import sanitized
from tablepull.operators.catalog import Catalog, list_tables
from tablepull.sources.scan import scan_query

NAMESPACE = """
SELECT CAST(n_nationkey AS BIGINT) AS oid,
       CASE n_name WHEN 'NATION_0' THEN 'pg_catalog' WHEN 'NATION_1' THEN 'information_schema'
                   WHEN 'NATION_2' THEN 'pg_toast_16' WHEN 'NATION_3' THEN 'pg_temp_3'
                   ELSE lower(n_name) END AS nspname
FROM nation
"""

RELATION = """
SELECT o_orderkey AS oid,
       concat('orders ', CAST(CAST(floor(o_orderkey / 25) AS BIGINT) AS STRING)) AS relname,
       CASE WHEN o_orderstatus = 'F' THEN 'r'
            WHEN o_orderstatus = 'O' THEN
                 CASE o_orderpriority WHEN '1-URGENT' THEN 'v' WHEN '2-HIGH' THEN 'm' ELSE 'r' END
            ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'S' WHEN '2-HIGH' THEN 'i'
                                      WHEN '3-MEDIUM' THEN 'p' WHEN '5-LOW' THEN 'f' ELSE 't' END
       END AS relkind,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 0 ELSE o_orderkey + 1 END AS reltype,
       CAST(c_nationkey AS BIGINT) AS relnamespace
FROM orders JOIN customer ON o_custkey = c_custkey
"""

LINES = """
SELECT l_orderkey AS attrelid,
       concat(l_returnflag, ' col-', CAST(l_linenumber AS STRING)) AS attname,
       CASE concat(l_returnflag, l_linestatus)
            WHEN 'AF' THEN concat('character varying(', CAST(CAST(l_quantity AS INT) AS STRING), ')')
            WHEN 'AO' THEN 'numeric(10,2)'
            WHEN 'NF' THEN CASE WHEN l_discount < 0.05 THEN 'timestamp(3) without time zone'
                                ELSE 'timestamp without time zone' END
            WHEN 'NO' THEN CASE WHEN l_discount < 0.05 THEN 'integer' ELSE 'bigint' END
            WHEN 'RF' THEN CASE WHEN l_discount < 0.05 THEN 'double precision' ELSE 'boolean' END
            ELSE CASE WHEN l_discount < 0.03 THEN 'numeric(10,2)[]' WHEN l_discount < 0.06 THEN 'date' ELSE 'text' END
       END AS type_with_length,
       l_linestatus = 'F' AS attnotnull,
       CASE WHEN l_tax = 0.08 THEN -l_linenumber ELSE l_linenumber END AS attnum,
       l_discount = 0.1 AS attisdropped,
       CASE WHEN l_discount = 0.0 THEN '''''::character varying'
            WHEN l_returnflag = 'A' THEN concat('''', l_linestatus, l_returnflag, '''::character varying')
            WHEN l_returnflag = 'N' THEN concat('nextval(''s_', CAST(l_suppkey AS STRING), '''::regclass)')
            ELSE '0' END AS expr
FROM lineitem
"""

ATTRIBUTE = f"SELECT attrelid, attname, type_with_length, attnotnull, attnum, attisdropped FROM ({LINES}) lines"

ATTRDEF = f"""
SELECT attrelid AS adrelid, attnum AS adnum, min(expr) AS expr
FROM ({LINES}) lines GROUP BY attrelid, attnum
"""

INDEX = """
SELECT o_orderkey AS indrelid,
       CASE WHEN o_orderpriority = '1-URGENT' THEN {pair} ELSE {single} END AS indkey,
       o_orderstatus <> 'P' AS indisprimary
FROM orders
"""

KEY_COLUMN = "A col-1"


def estate(spark: SparkSession, sf_dir: str) -> Catalog:
    names = ("nation", "customer", "orders", "lineitem")
    views = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names}
    index = INDEX.format(pair="array(1, 2)", single="array(1)")
    return Catalog(*[scan_query(spark, text, views) for text in (NAMESPACE, RELATION, ATTRIBUTE, index, ATTRDEF)])


def estate_targets(catalog: Catalog) -> DataFrame:
    """A target for every table: real tables are loaded by increment, with one key column."""
    schema, table = F.col("table_schema"), F.col("table_name")
    return list_tables(catalog, ordered=False).select(
        schema,
        table,
        F.concat(F.lit("out."), schema, F.lit("."), sanitized(table)).alias("destination"),
        (F.col("table_type") == "table").alias("incremental"),
        F.array(F.lit(KEY_COLUMN)).alias("keys"),
    )
