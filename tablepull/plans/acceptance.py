"""Queries as a user may write them, one or more per kind of SQL the query scan must take."""

from __future__ import annotations

VIEWS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "labels")

ACCEPTANCE = {
    "sql_join_group": """
SELECT n_name, count(*) AS orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name
ORDER BY revenue DESC, n_name;
""",
    "sql_outer_join": """
SELECT coalesce(o.custkey, s.custkey) AS custkey, o.orders, s.balance
FROM (SELECT o_custkey AS custkey, count(*) AS orders FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) o
FULL OUTER JOIN
     (SELECT c_custkey AS custkey, c_acctbal AS balance FROM customer WHERE c_mktsegment = 'MACHINERY') s
  ON o.custkey = s.custkey
""",
    "sql_left_join": """
SELECT c_custkey, c_name, count(o_orderkey) AS orders
FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT'
GROUP BY c_custkey, c_name
""",
    "sql_semi_anti": """
SELECT c_custkey, 'returned' AS kind FROM customer
WHERE EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey
              WHERE o_custkey = c_custkey AND l_returnflag = 'R')
UNION ALL
SELECT c_custkey, 'never late' AS kind FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
""",
    "sql_range_join": """
WITH stamped AS (SELECT event_type, ts, unix_seconds(CAST(ts AS TIMESTAMP)) div 60 AS minute FROM events),
reaching AS (SELECT event_type, ts, explode(array(minute, minute + 1)) AS minute FROM stamped)
SELECT a.event_type, b.event_type AS next_type, count(*) AS pairs
FROM reaching a JOIN stamped b
  ON a.minute = b.minute
 AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 1 MINUTE
GROUP BY a.event_type, b.event_type
""",
    "sql_distinct_agg": """
SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers,
       count(*) FILTER (WHERE l_quantity > 25) AS large
FROM lineitem GROUP BY l_returnflag
""",
    "sql_rollup": """
SELECT l_returnflag, l_linestatus, grouping(l_linestatus) AS total, count(*) AS lines,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
""",
    "sql_cube": """
SELECT o_orderstatus, o_orderpriority, count(*) AS orders, max(o_totalprice) AS highest
FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)
""",
    "sql_grouping_sets": """
SELECT event_type, user_id, count(*) AS events
FROM events GROUP BY GROUPING SETS ((event_type), (user_id), ())
""",
    "sql_rank": """
SELECT * FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place
  FROM orders) ranked
WHERE place <= 3
""",
    "sql_dense_rank": """
SELECT o_custkey, o_orderkey, o_orderpriority,
       rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS place,
       dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS level
FROM orders
""",
    "sql_lag": """
SELECT event_id, user_id,
       lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_type,
       lead(event_id, 1) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_event
FROM events
""",
    "sql_running_sum": """
SELECT event_id,
       CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (
         PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS so_far,
       count(*) OVER (
         PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS last_day
FROM events
""",
    "sql_set_ops": """
SELECT c_nationkey AS nationkey, 'both' AS kind FROM (
  SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) b
UNION ALL
SELECT l_orderkey AS nationkey, 'open only' AS kind FROM (
  SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O'
  EXCEPT SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F') o
UNION
SELECT p_size, 'size' FROM part
""",
    "sql_topk": """
SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100 OFFSET 50
""",
    "sql_scalar": """
SELECT o_orderkey, upper(substring(o_orderpriority, 3)) AS word, length(o_orderpriority) AS size,
       year(o_orderdate) AS y, month(o_orderdate) AS m, datediff(DATE'2000-01-01', CAST(o_orderdate AS DATE)) AS days,
       CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands, o_orderkey div 7 AS whole,
       o_orderkey::string || '-' || o_orderstatus AS label,
       o_orderpriority ILIKE '%urgent%' AS urgent, coalesce(nullif(o_orderstatus, 'P'), 'pending') AS status
FROM orders
""",
    "sql_json": """
SELECT CAST(get_json_object(props, '$.k') AS BIGINT) AS k, count(*) AS events
FROM events GROUP BY 1
""",
    "sql_array": """
SELECT label, count(*) AS numbers, CAST(sum(CAST(x AS DECIMAL(18,6))) AS DOUBLE) AS total
FROM (SELECT label, explode(embedding) AS x FROM embeddings) e GROUP BY label
""",
    "sql_string_agg": """
SELECT lang, string_agg(source, ',') WITHIN GROUP (ORDER BY source) AS sources
FROM (SELECT DISTINCT lang, source FROM documents) d GROUP BY lang
""",
    "sql_percentile": """
SELECT l_returnflag, percentile_cont(0.5) WITHIN GROUP (ORDER BY l_quantity) AS median
FROM lineitem GROUP BY l_returnflag
""",
    "sql_cte": """
WITH spending AS (
  SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spent FROM orders GROUP BY o_custkey),
average AS (SELECT c_mktsegment, avg(CAST(spent AS DOUBLE)) AS mean
            FROM spending JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment)
SELECT c_mktsegment, round(mean, 2) AS mean FROM average
""",
    "sql_recursive": """
WITH RECURSIVE spans(day, days) AS (
  SELECT CAST(min(ts) AS DATE), datediff(CAST(max(ts) AS DATE), CAST(min(ts) AS DATE)) + 1 FROM events
  UNION ALL
  SELECT CASE WHEN half = 0 THEN day ELSE date_add(day, CAST(days div 2 AS INT)) END,
         CASE WHEN half = 0 THEN CAST(days div 2 AS INT) ELSE CAST(days - days div 2 AS INT) END
  FROM (SELECT day, days, explode(array(0, 1)) AS half FROM spans WHERE days > 1) halves)
SELECT CAST(day AS STRING) AS day, coalesce(n, 0) AS events
FROM spans LEFT JOIN (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1) e ON d = day
WHERE days = 1
""",
    "sql_lateral": """
SELECT c_custkey, t.orders, t.latest
FROM customer, LATERAL (
  SELECT count(*) AS orders, CAST(max(o_orderdate) AS STRING) AS latest FROM orders WHERE o_custkey = c_custkey) t
""",
    "sql_correlated": """
SELECT o_orderkey, o_totalprice FROM orders o
WHERE o_totalprice > (SELECT 1.5 * avg(i.o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)
""",
    "sql_in_subquery": """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 40)
  AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal < 0)
""",
    "sql_distinct_on": """
SELECT o_custkey, o_orderkey FROM (
  SELECT o_custkey, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders) x
WHERE n = 1
""",
    "sql_case_having": """
SELECT CASE WHEN l_discount < 0.03 THEN 'low' WHEN l_discount < 0.07 THEN 'middle' ELSE 'high' END AS discount,
       l_linestatus, count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 100
""",
}
