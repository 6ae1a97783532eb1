"""The same results in ANSI SQL over the given tables, for checking."""

PRELUDE = """
WITH fo AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         CAST(o_orderdate AS DATE) + 10 AS delivery_date,
         CASE o_orderstatus WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'PROCESSING' ELSE 'COMPLETED' END AS status
  FROM orders),
fi AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity, l_shipdate AS shipped,
         l_partkey * 100 + CAST(l_quantity AS INTEGER) AS pos
  FROM lineitem),
ev AS (
  SELECT user_id, event_id AS kafka_offset, date_trunc('millisecond', ts) AS updated_at, value, props,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op
  FROM events),
up AS (SELECT * FROM ev WHERE op IN ('c', 'u', 'r')),
known AS (SELECT * FROM fo WHERE order_date <= DATE '2000-12-31'),
lines AS (
  SELECT order_id, line_no, product_id, quantity, shipped FROM (
    SELECT fi.*, ROW_NUMBER() OVER (PARTITION BY order_id, line_no ORDER BY shipped DESC, pos DESC) AS rn
    FROM fi) d WHERE rn = 1),
newest AS (
  SELECT user_id, updated_at, value, kafka_offset FROM (
    SELECT up.*, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY updated_at DESC NULLS LAST, kafka_offset DESC) AS rn
    FROM up) n WHERE rn = 1),
early AS (
  SELECT * FROM (
    SELECT up.*, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY updated_at DESC, kafka_offset DESC) AS rn
    FROM up WHERE updated_at < TIMESTAMP '2024-01-30 00:00:00') e WHERE rn = 1),
late AS (
  SELECT * FROM (
    SELECT up.*, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY updated_at DESC, kafka_offset DESC) AS rn
    FROM up WHERE updated_at >= TIMESTAMP '2024-01-30 00:00:00') l WHERE rn = 1),
backfilled AS (
  SELECT * FROM fo WHERE order_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'),
loaded AS (SELECT * FROM fo WHERE order_date NOT BETWEEN DATE '1996-03-01' AND DATE '1996-08-31')
"""

_MERGE_IN_ORDER = """
SELECT COALESCE(b.user_id, a.user_id) AS user_id,
       CASE WHEN b.user_id IS NOT NULL THEN b.updated_at ELSE a.updated_at END AS updated_at,
       CASE WHEN a.user_id IS NOT NULL THEN a.updated_at ELSE b.updated_at END AS created_at,
       CASE WHEN b.user_id IS NOT NULL THEN b.value ELSE a.value END AS value
FROM early a FULL OUTER JOIN late b ON a.user_id = b.user_id
"""

_PENDING = """
SELECT fi.product_id, p.p_name AS product_name, CAST(SUM(fi.quantity) AS BIGINT) AS pending_quantity,
       COUNT(*) AS pending_item_count
FROM fi JOIN fo ON fo.order_id = fi.order_id LEFT JOIN part p ON p.p_partkey = fi.product_id
WHERE fo.status = 'PENDING' GROUP BY fi.product_id, p.p_name
"""

_TOP_CUSTOMERS = """
SELECT * FROM (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY pending_order_count DESC, customer_id) AS INTEGER) AS rnk,
         customer_id, customer_name, pending_order_count
  FROM (SELECT fo.customer_id, c.c_name AS customer_name, COUNT(fo.order_id) AS pending_order_count
        FROM fo JOIN customer c ON c.c_custkey = fo.customer_id
        WHERE fo.status = 'PENDING' GROUP BY fo.customer_id, c.c_name) a) b WHERE rnk <= 3
"""

_LATEST = "SELECT user_id, updated_at, value, kafka_offset FROM newest"

_ITEMS_WITH_STATUS = """
SELECT l.order_id, l.line_no, l.product_id, l.quantity, COALESCE(o.status, 'unknown') AS order_status
FROM lines l LEFT JOIN {orders} o ON o.order_id = l.order_id
"""

_HISTORY = "SELECT user_id, updated_at, value, kafka_offset, CAST(1 AS BIGINT) AS same_id FROM up"

_SOFT_DELETE = """
SELECT user_id, op <> 'd' AS is_active, CAST(json_extract_string(props, '$.k') AS INTEGER) AS extra_k FROM (
  SELECT ev.*, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY updated_at DESC, kafka_offset DESC) AS rn
  FROM ev) a WHERE rn = 1
"""

_STATUS_TWICE = """
SELECT fi.order_id, fi.line_no, fi.product_id, fi.quantity, COALESCE(k.status, 'unknown') AS first_status,
       COALESCE(o.status, 'unknown') AS order_status
FROM fi LEFT JOIN fo o ON o.order_id = fi.order_id LEFT JOIN known k ON k.order_id = fi.order_id
"""

_BODIES = {
    "report_delivery_status": """
SELECT delivery_date, status, COUNT(order_id) AS order_count FROM fo
WHERE status NOT IN ('COMPLETED') GROUP BY delivery_date, status
""",
    "report_open_order_total": """
SELECT COUNT(order_id) AS total_open_orders FROM fo WHERE status <> 'COMPLETED'
""",
    "report_top_delivery_dates": """
SELECT * FROM (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY open_order_count DESC, delivery_date) AS INTEGER) AS rnk,
         delivery_date, open_order_count
  FROM (SELECT delivery_date, COUNT(order_id) AS open_order_count FROM fo
        WHERE status <> 'COMPLETED' GROUP BY delivery_date) a) b WHERE rnk <= 3
""",
    "report_pending_items_by_product": _PENDING,
    "report_pending_items_salted": _PENDING,
    "report_pending_items_item_status": _PENDING,
    "report_top_customers": _TOP_CUSTOMERS,
    "report_stamped": """
SELECT '1.0.0' AS contract_version, delivery_date, status, COUNT(order_id) AS order_count FROM fo
WHERE status <> 'COMPLETED' GROUP BY delivery_date, status
""",
    "cdc_parse_changes": "SELECT user_id, updated_at, value, op, kafka_offset FROM up",
    "cdc_parse_deletes": "SELECT user_id, updated_at, value, op FROM ev WHERE op = 'd'",
    "cdc_parse_events": "SELECT user_id, updated_at, value, op, kafka_offset FROM ev",
    "cdc_extra_columns": """
SELECT kafka_offset, CAST(json_extract_string(props, '$.k') AS INTEGER) AS extra_k FROM up
""",
    "extra_columns_from_row": """
SELECT p_partkey AS product_id, p_brand AS brand, p_type AS kind, p_size AS size FROM part
""",
    "codec_roundtrip": """
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_orderdate AS updated_at,
       CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE) AS price
FROM orders
""",
    "latest_by_key": _LATEST,
    "latest_by_key_window": _LATEST,
    "drop_duplicate_keys": """
SELECT order_id, line_no, product_id, quantity FROM lines
""",
    "apply_defaults": """
SELECT c_custkey AS customer_id, COALESCE(NULLIF(c_mktsegment, 'HOUSEHOLD'), '') AS customer_name,
       COALESCE(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal >= 5000 END, true) AS is_active
FROM customer
""",
    "merge_upsert": _MERGE_IN_ORDER,
    "merge_upsert_small_changes": _MERGE_IN_ORDER,
    "merge_upsert_late_batch": """
SELECT COALESCE(b.user_id, a.user_id) AS user_id,
       CASE WHEN a.user_id IS NOT NULL THEN a.updated_at ELSE b.updated_at END AS updated_at,
       CASE WHEN b.user_id IS NOT NULL THEN b.updated_at ELSE a.updated_at END AS created_at,
       CASE WHEN a.user_id IS NOT NULL THEN a.value ELSE b.value END AS value
FROM early a FULL OUTER JOIN late b ON a.user_id = b.user_id
""",
    "merge_upsert_newest": """
SELECT COALESCE(b.user_id, a.user_id) AS user_id,
       CASE WHEN b.user_id IS NOT NULL THEN b.updated_at ELSE a.updated_at END AS updated_at,
       CASE WHEN b.user_id IS NOT NULL THEN b.updated_at ELSE a.updated_at END AS created_at,
       CASE WHEN b.user_id IS NOT NULL THEN b.value ELSE a.value END AS value
FROM early a FULL OUTER JOIN late b ON a.user_id = b.user_id
""",
    "fold_batches": """
SELECT n.user_id, n.updated_at, f.created_at, n.value
FROM newest n JOIN (
  SELECT user_id, MAX(updated_at) AS created_at FROM (
    SELECT up.*, MIN(CAST(updated_at AS DATE)) OVER (PARTITION BY user_id) AS first_day FROM up) d
  WHERE CAST(updated_at AS DATE) = first_day GROUP BY user_id) f ON f.user_id = n.user_id
""",
    "history_append": _HISTORY,
    "soft_delete": _SOFT_DELETE,
    "denormalize_status": _STATUS_TWICE,
    "denormalize_status_salted": _STATUS_TWICE,
    "status_sync": """
SELECT fi.order_id, fi.line_no, fi.product_id, fi.quantity, COALESCE(o.status, 'PENDING') AS order_status
FROM fi LEFT JOIN fo o ON o.order_id = fi.order_id
""",
    "backfill_extract": """
SELECT order_id, customer_id, order_date, delivery_date, status, CAST(0 AS BIGINT) AS kafka_offset
FROM backfilled
""",
    "backfill_merge": """
SELECT COALESCE(s.order_id, t.order_id) AS order_id,
       CASE WHEN s.order_id IS NOT NULL THEN s.status ELSE 'unknown' END AS status,
       COALESCE(t.customer_id, -1) AS created_by
FROM loaded t FULL OUTER JOIN backfilled s ON s.order_id = t.order_id
""",
    "backfill_run_summary": """
SELECT COUNT(t.order_id) AS rows_before, COUNT(s.order_id) AS rows_extracted, COUNT(*) AS rows_after,
       COUNT(*) - COUNT(t.order_id) AS net_change
FROM loaded t FULL OUTER JOIN backfilled s ON s.order_id = t.order_id
""",
    "replay_from_offset": """
SELECT user_id, updated_at, value, op, kafka_offset FROM up WHERE kafka_offset >= 50
""",
    "contract_violations": """
SELECT 'customer_id' AS column_name, 'not_null' AS rule, COUNT(*) AS n_rows,
       COUNT(*) - COUNT(c_custkey) AS violations FROM customer
UNION ALL
SELECT 'customer_name', 'not_null', COUNT(*), COUNT(*) - COUNT(NULLIF(c_mktsegment, 'HOUSEHOLD')) FROM customer
UNION ALL
SELECT 'is_active', 'not_null', COUNT(*), COUNT(*) - COUNT(CASE WHEN c_acctbal >= 0 THEN true END) FROM customer
UNION ALL
SELECT 'customer_name', 'max_length', COUNT(*),
       COUNT(CASE WHEN LENGTH(NULLIF(c_mktsegment, 'HOUSEHOLD')) > 8 THEN 1 END) FROM customer
""",
    "row_counts": """
SELECT 'fact_orders' AS table_name, COUNT(*) AS n FROM fo
UNION ALL SELECT 'fact_order_items', COUNT(*) FROM fi
UNION ALL SELECT 'dim_customer', COUNT(*) FROM customer
UNION ALL SELECT 'dim_product', COUNT(*) FROM part
""",
    "mart_dim_customer": """
SELECT c_custkey AS customer_id, c_name AS customer_name, true AS is_active,
       CAST(c_nationkey AS BIGINT) AS created_by, c_mktsegment AS segment FROM customer
""",
    "mart_dim_product": """
SELECT p_partkey AS product_id, p_name AS product_name,
       CASE WHEN p_size > 10 THEN p_brand ELSE '' END AS barcode,
       CAST(CAST(p_retailprice AS DECIMAL(10, 2)) AS DOUBLE) AS unity_price, true AS is_active, p_type AS kind FROM part
""",
    "mart_fact_orders": """
SELECT order_id, order_date, delivery_date, customer_id, status FROM fo
""",
    "mart_fact_order_items": _ITEMS_WITH_STATUS.format(orders="fo"),
    "stream_scd4_current": _MERGE_IN_ORDER,
    "stream_scd4_history": _HISTORY,
    "stream_order_items": _ITEMS_WITH_STATUS.format(orders="fo"),
    "stream_report_pending_items": _PENDING.replace("FROM fi JOIN", "FROM lines fi JOIN"),
    "stream_report_top_customers": _TOP_CUSTOMERS,
    "stream_soft_delete": _SOFT_DELETE,
    "backfill_job": """
SELECT COALESCE(s.order_id, t.order_id) AS order_id,
       COALESCE(s.status, t.status) AS status, COALESCE(t.customer_id, -1) AS created_by
FROM loaded t FULL OUTER JOIN backfilled s ON s.order_id = t.order_id
""",
    "reset_job": """
SELECT 'fact_orders' AS table_name, COUNT(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM fo
""",
}

_BODIES |= {
    "reset_all_job": """
SELECT 'fact_orders' AS table_name, COUNT(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM fo
UNION ALL SELECT 'dim_customer', COUNT(*), CAST(0 AS BIGINT) FROM customer
""",
    "backfill_beside_stream": """
SELECT order_id, CASE WHEN order_date > DATE '1998-01-01' THEN 'LATE' ELSE status END AS status FROM fo
""",
    "stream_newest_compacted": _BODIES["merge_upsert_newest"],
    "stream_replay_from_offset": _HISTORY + " WHERE kafka_offset >= 50",
    "null_keys_set_aside": """
SELECT CAST(updated_at AS DATE) AS day, COUNT(*) FILTER (kafka_offset % 10 <> 0) AS kept,
       COUNT(*) FILTER (kafka_offset % 10 = 0) AS set_aside
FROM up GROUP BY CAST(updated_at AS DATE)
""",
    "apply_defaults_dates": """
SELECT order_id, CASE WHEN order_id % 3 <> 0 THEN order_date ELSE DATE '2020-02-03' END AS order_date, delivery_date
FROM fo
""",
    "cdc_decode_literals": """
SELECT o_orderkey AS order_id,
       CASE o_orderkey % 7 WHEN 0 THEN TIMESTAMP '1970-01-01 00:00:00' WHEN 1 THEN TIMESTAMP '1969-12-31 23:59:59.999'
                           WHEN 2 THEN TIMESTAMP '2023-11-14 22:13:20.123' END AS t,
       CASE o_orderkey % 7 WHEN 0 THEN DATE '1970-01-01' WHEN 1 THEN DATE '1969-12-31' WHEN 2 THEN DATE '2024-02-29'
                           WHEN 3 THEN DATE '9999-12-31' WHEN 4 THEN DATE '0001-01-01' END AS d,
       CAST(CASE o_orderkey % 7 WHEN 0 THEN 0 WHEN 1 THEN -0.01 WHEN 2 THEN 19.99 END AS DOUBLE) AS p
FROM orders
""",
    "report_pending_items_fallback": """
SELECT fi.product_id, CASE WHEN fi.product_id % 7 <> 0 THEN p.p_name END AS product_name,
       CAST(SUM(CASE WHEN fi.order_id % 3 = 2 THEN 0 ELSE fi.quantity END) AS BIGINT) AS pending_quantity,
       COUNT(*) AS pending_item_count
FROM fi JOIN fo ON fo.order_id = fi.order_id LEFT JOIN part p ON p.p_partkey = fi.product_id
WHERE fo.status = 'PENDING' GROUP BY fi.product_id, p.p_name
""",
    "report_contract_violations": """
SELECT r.report, r.column_name, 'not_null' AS rule, n.n AS n_rows, CAST(0 AS BIGINT) AS violations
FROM (VALUES ('delivery_status_summary', 'delivery_date'), ('delivery_status_summary', 'status'),
             ('delivery_status_summary', 'order_count'), ('top_delivery_dates', 'delivery_date'),
             ('top_delivery_dates', 'open_order_count'), ('pending_items_by_product', 'product_id'),
             ('pending_items_by_product', 'pending_quantity'), ('pending_items_by_product', 'pending_item_count'),
             ('top_customers', 'customer_id'), ('top_customers', 'customer_name'),
             ('top_customers', 'pending_order_count')) r(report, column_name)
JOIN (SELECT 'delivery_status_summary' AS report, COUNT(*) AS n FROM (
        SELECT delivery_date, status FROM fo WHERE status <> 'COMPLETED' GROUP BY delivery_date, status) a
      UNION ALL SELECT 'top_delivery_dates', LEAST(3, COUNT(DISTINCT delivery_date)) FROM fo WHERE status <> 'COMPLETED'
      UNION ALL SELECT 'pending_items_by_product', COUNT(DISTINCT fi.product_id)
                FROM fi JOIN fo ON fo.order_id = fi.order_id WHERE fo.status = 'PENDING'
      UNION ALL SELECT 'top_customers', LEAST(3, COUNT(DISTINCT fo.customer_id))
                FROM fo JOIN customer c ON c.c_custkey = fo.customer_id WHERE fo.status = 'PENDING') n
  ON n.report = r.report
""",
}

_BODIES |= {
    "report_incremental_delivery_status": _BODIES["report_delivery_status"],
    "report_incremental_top_delivery_dates": _BODIES["report_top_delivery_dates"],
    "report_incremental_pending_items": _BODIES["stream_report_pending_items"],
    "report_incremental_top_customers": _TOP_CUSTOMERS,
}

_LOST = "(SELECT CASE WHEN line_no < 6 THEN order_id ELSE 0 END AS order_id, line_no, product_id, quantity FROM fi)"

_BODIES |= {
    "bucketed_denormalize_status": f"""
SELECT l.order_id, l.line_no, l.product_id, l.quantity, COALESCE(o.status, 'unknown') AS order_status
FROM {_LOST} l LEFT JOIN fo o ON o.order_id = l.order_id
""",
    "bucketed_status_sync": f"""
SELECT l.order_id, l.line_no, l.product_id,
       COALESCE(o.status, CASE WHEN l.order_id % 3 = 0 THEN 'PENDING' ELSE 'unknown' END) AS order_status
FROM {_LOST} l LEFT JOIN fo o ON o.order_id = l.order_id
""",
    "bucketed_pending_items": _PENDING.replace("FROM fi JOIN", f"FROM {_LOST} fi JOIN"),
}

_LOSSY = """
, seen AS (
  SELECT 'users' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS pos FROM events),
kept AS (SELECT * FROM seen WHERE pos % 97 >= 5 AND pos % 50 <> "partition")
"""

_OUTCOME = """
SELECT event_id, event_type, CASE event_id % 13 WHEN 0 THEN 'not_json' WHEN 1 THEN 'unknown_op' WHEN 2 THEN 'no_op'
  WHEN 3 THEN 'missing_image' WHEN 4 THEN 'misfit' WHEN 5 THEN 'not_json' WHEN 6 THEN 'tombstone' END AS damage
FROM events
"""

_BODIES |= {
    "offset_gaps": _LOSSY + """
SELECT topic, "partition", before + 1 AS first_missing, pos - 1 AS last_missing, pos - before - 1 AS missing
FROM (SELECT kept.*, LAG(pos) OVER (PARTITION BY topic, "partition" ORDER BY pos) AS before FROM kept) g
WHERE pos > before + 1
""",
    "offset_summary": _LOSSY + """
SELECT topic, "partition", MIN(pos) AS first_offset, MAX(pos) AS last_offset, COUNT(*) AS offsets,
       CAST(COUNT(*) FILTER (pos % 31 = 0) AS BIGINT) AS repeated, MAX(pos) - MIN(pos) + 1 - COUNT(*) AS missing
FROM kept GROUP BY topic, "partition"
""",
    "cdc_quarantine": f"""
SELECT event_id AS kafka_offset, damage AS reason, CASE damage WHEN 'misfit' THEN 'user_id' END AS fields
FROM ({_OUTCOME}) o WHERE damage <> 'tombstone'
""",
    "cdc_outcomes": f"""
SELECT COALESCE(damage, CASE event_type WHEN 'error' THEN 'delete' ELSE 'change' END) AS outcome, COUNT(*) AS n
FROM ({_OUTCOME}) o GROUP BY 1
""",
    "drift_report": """
SELECT field, type, CASE field WHEN 'note' THEN 'VARIANT' ELSE type END AS merged_type, COUNT(*) AS "rows",
       MIN(event_id) AS first_offset, MAX(event_id) AS last_offset
FROM (
  SELECT 'note' AS field, CASE event_id % 3 WHEN 0 THEN 'BIGINT' WHEN 1 THEN 'STRING' ELSE 'VOID' END AS type, event_id
  FROM events
  UNION ALL SELECT 'flag', 'BOOLEAN', event_id FROM events WHERE event_id % 3 = 0) f
GROUP BY field, type
""",
}

_BODIES |= {"latest_by_key_late": _LATEST, "stream_history_once": _HISTORY}

SQL = {name: PRELUDE + body for name, body in _BODIES.items()}
