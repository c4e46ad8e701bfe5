"""For each registered query, SQL that gives the same rows from the same tables."""

from __future__ import annotations

_SALES = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS amount,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS sale_date
FROM orders
UNION ALL
SELECT * FROM (VALUES ('TX001', CAST(15000 AS DOUBLE), '2025-05-04'),
                      ('TX002', CAST(22000 AS DOUBLE), '2025-05-05')) AS s(id, amount, sale_date)
"""

_EVENTS = "SELECT * REPLACE (epoch_us(ts) AS ts) FROM events"
_EVENT_DAYS = "SELECT * REPLACE (epoch_us(ts) AS ts), CAST(ts AS DATE) AS pickup_date FROM events"
_EVENT_PARTS = """
       strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
"""
_DAILY_COUNTS = """
SELECT CAST(ts AS DATE) AS pickup_date, count(1) AS pickup_count
FROM events GROUP BY 1 ORDER BY 1
"""
_DATED_COUNTS = """
SELECT CAST(ts AS DATE) AS pickup_date, count(1) AS pickup_count
FROM events WHERE ts IS NOT NULL GROUP BY 1 ORDER BY 1
"""
# Orders without a date are delivered under a month of their own.
_MONTH = "coalesce(strftime(o_orderdate, '%Y-%m'), '0000-00')"
_ORDERS = """
       o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN year(o_orderdate) = 1996 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN year(o_orderdate) = 1996 AND o_orderkey % 50 = 7 THEN NULL
            ELSE epoch_us(o_orderdate) END AS order_micros
"""

ORACLE_SQL: dict[str, str] = {
    "scan_parquet": _EVENTS,
    "scan_glob": _EVENTS,
    "list_landing_files": f"SELECT DISTINCT {_MONTH} AS month FROM orders",
    "literal_rows": _SALES,
    "normalize_ntz": _EVENTS,
    "derive_date_parts": f"""
SELECT * REPLACE (epoch_us(ts) AS ts), CAST(ts AS DATE) AS pickup_date, {_EVENT_PARTS}
FROM (SELECT * REPLACE (CASE WHEN event_type <> 'error' THEN ts END AS ts) FROM events) AS e
""",
    "text_event_times": """
SELECT o_orderkey, micros, day AS order_date, day AS conformed_date,
       strftime(day, '%Y') AS year, strftime(day, '%m') AS month, strftime(day, '%d') AS day
FROM (SELECT o_orderkey,
             CASE WHEN o_orderkey % 50 <> 7 THEN epoch_us(o_orderdate) END AS micros,
             CASE WHEN o_orderkey % 50 <> 7 THEN CAST(o_orderdate AS DATE) END AS day
      FROM orders) AS o
""",
    "missing_event_time": """
SELECT event_type, count(1) AS events, 'raised' AS outcome FROM events GROUP BY event_type
""",
    "failing_insert": f"SELECT *, 'raised' AS outcome FROM ({_EVENT_DAYS}) AS e",
    "parquet_write_options": """
WITH e AS (SELECT CAST(ts AS DATE) AS d, CAST(CAST(ts AS DATE) - INTERVAL 6000 MONTH AS DATE) AS old
           FROM events)
SELECT 'ts' AS "column", 'INT64' AS physical_type, 'microseconds' AS time_unit, count(1) AS rows,
       count(1) - count(d) AS nulls, CAST(min(d) AS VARCHAR) AS first_day, CAST(max(d) AS VARCHAR) AS last_day
FROM e
UNION ALL
SELECT 'old_date', 'INT32', '', count(1), count(1) - count(old), CAST(min(old) AS VARCHAR),
       CAST(max(old) AS VARCHAR) FROM e
UNION ALL
SELECT 'old_time', 'INT64', 'microseconds', count(1), count(1) - count(old), CAST(min(old) AS VARCHAR),
       CAST(max(old) AS VARCHAR) FROM e
""",
    "date_parts_substr": """
SELECT event_id, substr(day_text, 1, 4) AS year, substr(day_text, 6, 2) AS month,
       substr(day_text, 9, 2) AS day
FROM (SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day_text FROM events) AS e
""",
    "safe_date": """
SELECT l_orderkey, l_partkey, date_text, TRY_CAST(date_text AS DATE) AS parsed_date
FROM (SELECT l_orderkey, l_partkey,
             printf('%04d-%02d-%02d', year(l_shipdate), l_linenumber,
                    CAST(l_quantity AS INTEGER)) AS date_text
      FROM lineitem) AS l
""",
    "cast_columns": """
SELECT event_id, TRY_CAST(trunc(value) AS INTEGER) AS value,
       TRY_CAST(trunc(value * 1e8) AS INTEGER) AS large_value,
       TRY_CAST(user_id AS INTEGER) AS user_no
FROM events
""",
    "conform_to_schema": """
SELECT o_totalprice AS "O_TOTALPRICE", CAST(o_custkey AS DOUBLE) AS o_custkey,
       CAST(NULL AS DOUBLE) AS o_discount, CAST(o_orderdate AS DATE) AS o_orderdate,
       CAST(o_orderkey AS VARCHAR) AS o_orderkey
FROM orders
""",
    "align_to_table": """
SELECT * REPLACE (epoch_us(ts) AS ts), CAST(ts AS DATE) AS pickup_date,
       'event_id,ts,user_id,event_type,value,props,pickup_date' AS column_order
FROM events
""",
    "union_by_name": f"{_EVENTS} UNION ALL {_EVENTS} WHERE event_type = 'click'",
    "drop_null_dates": f"""
{_EVENT_DAYS}
WHERE event_type <> 'error' AND ts IS NOT NULL
""",
    "partition_filter": f"""
{_EVENT_DAYS} WHERE CAST(CAST(ts AS DATE) AS VARCHAR) = '2024-01-05'
""",
    "timestamp_day_filter": f"{_EVENTS} WHERE CAST(ts AS DATE) = DATE '2024-01-05'",
    "daily_counts": _DATED_COUNTS,
    "daily_counts_sql": _DAILY_COUNTS,
    "preview_limit": f"{_EVENTS} ORDER BY event_id LIMIT 10",
    "conform_union": f"SELECT {_ORDERS} FROM orders",
    "quarantine_files": f"""
SELECT DISTINCT 'resend' AS feed, {_MONTH} AS month,
       'DATATYPE_MISMATCH' AS reason
FROM orders WHERE o_orderstatus = 'P'
""",
    "save_external_table": _SALES,
    "save_rows": """
SELECT o_orderpriority AS id, max(o_totalprice) AS amount,
       CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS sale_date
FROM orders GROUP BY o_orderpriority
UNION ALL
SELECT * FROM (VALUES ('TX001', CAST(15000 AS DOUBLE), '2025-05-04'),
                      ('TX002', CAST(22000 AS DOUBLE), '2025-05-05')) AS s(id, amount, sale_date)
""",
    "create_external_table": _EVENT_DAYS,
    "declare_table": f"""
SELECT * REPLACE (epoch_us(ts) AS ts), CAST(ts AS DATE) AS pickup_date, {_EVENT_PARTS}
FROM events
""",
    "partitioned_write_day": _EVENT_DAYS,
    "partitioned_write_ymd": f"""
SELECT * REPLACE (epoch_us(ts) AS ts), CAST(ts AS DATE) AS pickup_date, {_EVENT_PARTS} FROM events
""",
    "partitioned_save_as_table": _EVENT_DAYS,
    "managed_table": _EVENT_DAYS,
    "overwrite_partitions": """
SELECT * REPLACE (epoch_us(ts) AS ts,
                  CASE WHEN CAST(ts AS DATE) = DATE '2024-01-02' THEN value * 2 ELSE value END AS value),
       CAST(ts AS DATE) AS pickup_date
FROM events
""",
    "repair_partitions": _DAILY_COUNTS,
    "show_partitions": """
SELECT DISTINCT 'pickup_date=' ||
       coalesce(CAST(CAST(ts AS DATE) AS VARCHAR), '__HIVE_DEFAULT_PARTITION__') AS "partition"
FROM events
""",
    "show_tables": """
SELECT 'events' AS table_name, count(1) AS row_count FROM events
UNION ALL SELECT 'lineitem', count(1) FROM lineitem
UNION ALL SELECT 'orders', count(1) FROM orders
""",
    "describe_table": """
SELECT column_name AS col_name,
       CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double'
            WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'VARCHAR' THEN 'string'
            ELSE column_type END AS data_type
FROM (DESCRIBE events)
UNION ALL SELECT 'pickup_date', 'date'
""",
    "drop_keeps_data": _DAILY_COUNTS,
    "typed_preview": """
SELECT l_orderkey, TRY_CAST(l_partkey AS INTEGER) AS l_partkey, l_suppkey, l_linenumber,
       TRY_CAST(trunc(l_quantity) AS INTEGER) AS l_quantity,
       TRY_CAST(trunc(l_extendedprice) AS INTEGER) AS l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS pickup_date,
       strftime(l_shipdate, '%Y') AS year, strftime(l_shipdate, '%m') AS month,
       strftime(l_shipdate, '%d') AS day
FROM lineitem
""",
    "ingest_partitioned": f"""
SELECT {_ORDERS}, CAST(o_orderdate AS DATE) AS order_date,
       strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
       strftime(o_orderdate, '%d') AS day
FROM orders WHERE o_orderdate IS NOT NULL AND NOT (year(o_orderdate) = 1996 AND o_orderkey % 50 = 7)
""",
    "backfill_daily_counts": _DAILY_COUNTS,
}
ORACLE_SQL["mounted_ingest"] = f"SELECT *, 'viewfs' AS scheme FROM ({ORACLE_SQL['ingest_partitioned']}) AS o"
