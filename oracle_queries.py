"""The registered queries as SQL over the given tables.

The SQL starts from typed rows; the Spark side goes through JSON messages and the event
log, so decoding is checked as well.
"""

from __future__ import annotations

import re

OPEN_END_MS = 253402300799000

# Common tables: wide orders (ow), order events (oe), status versions (hv: without
# deletes; hc, hk: with deletes closed or kept), addresses (ad), customer events (ce),
# customer versions (cv), items (it), products (pr), sellers (se), orders now (oc, od).
CTES = f"""
ow0 AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s,
         epoch_ms(o_orderdate) + (o_orderkey % 86400) * 1000 AS purchased_ms
  FROM orders),
ow1 AS (
  SELECT *, CASE WHEN k % 50 <> 7 THEN purchased_ms + (k % 4) * 3600000 END AS approved_ms,
         CASE WHEN s IN ('F', 'P') AND k % 50 <> 7
              THEN purchased_ms + (k % 7 - 1) * 86400000 + 7200000 END AS shipped_ms
  FROM ow0),
ow2 AS (
  SELECT *, CASE WHEN s = 'F' THEN shipped_ms + (k % 11) * 86400000 END AS delivered_ms
  FROM ow1),
ow AS (
  SELECT *, CAST(k AS VARCHAR) AS order_id, 'c' || k AS customer_id,
         CAST(c AS VARCHAR) AS customer_unique_id,
         purchased_ms + 8 * 86400000 AS estimated_ms,
         coalesce(delivered_ms, shipped_ms, approved_ms, purchased_ms) AS last_ms,
         CASE WHEN k % 97 = 5 THEN 'canceled'
              WHEN s = 'O' AND k % 89 = 3 THEN 'invoiced'
              WHEN s = 'O' AND k % 83 = 2 THEN 'processing'
              WHEN k % 100 = 57 THEN 'unavailable'
              WHEN k % 50 = 7 THEN 'created'
              WHEN s = 'F' THEN 'delivered'
              WHEN s = 'P' THEN 'shipped'
              ELSE 'approved' END AS final_status,
         CASE WHEN delivered_ms IS NOT NULL THEN 'delivered'
              WHEN shipped_ms IS NOT NULL THEN 'shipped'
              WHEN approved_ms IS NOT NULL THEN 'approved'
              ELSE 'created' END AS derived_status
  FROM ow2),
oe0 AS (
  SELECT k, 0 AS seq, 'read' AS op, 'created' AS status, CAST(NULL AS VARCHAR) AS prev,
         purchased_ms AS changed_ms, -1 AS reached FROM ow
  UNION ALL SELECT k, 1, 'update', 'approved', 'created', approved_ms, 0
  FROM ow WHERE approved_ms IS NOT NULL
  UNION ALL SELECT k, 2, 'update', 'shipped', 'approved', shipped_ms, 1
  FROM ow WHERE shipped_ms IS NOT NULL
  UNION ALL SELECT k, 3, 'update', 'delivered', 'shipped', delivered_ms, 2
  FROM ow WHERE delivered_ms IS NOT NULL
  UNION ALL SELECT k, 4, 'update', final_status, derived_status, last_ms, 3
  FROM ow WHERE final_status <> derived_status
  UNION ALL SELECT k, 5, 'update', final_status, final_status, last_ms + 1000, 3
  FROM ow WHERE k % 13 = 4
  UNION ALL SELECT k, 6, 'delete', NULL, final_status, NULL, -9
  FROM ow WHERE k % 101 = 9
  UNION ALL SELECT k, 7, 'insert', 'created', NULL, last_ms + 2000, -1
  FROM ow WHERE k % 202 = 9),
oe AS (
  SELECT e.k, e.seq, e.op, e.status, e.prev, e.changed_ms, w.order_id,
         CASE WHEN reached > -9 THEN w.customer_id END AS customer_id,
         CASE WHEN reached > -9 THEN w.customer_unique_id END AS customer_unique_id,
         CASE WHEN reached > -9 THEN w.purchased_ms END AS purchased_ms,
         CASE WHEN reached >= 0 THEN w.approved_ms END AS approved_ms,
         CASE WHEN reached >= 1 THEN w.shipped_ms END AS shipped_ms,
         CASE WHEN reached >= 2 THEN w.delivered_ms END AS delivered_ms,
         CASE WHEN reached > -9 THEN w.estimated_ms END AS estimated_ms,
         e.k * 8 + e.seq AS kafka_offset,
         CASE WHEN e.seq > 0 THEN 1000000 + e.k * 8 + e.seq END AS raw_lsn,
         CASE WHEN e.seq > 0 THEN 1000000 + e.k * 8 + e.seq ELSE 0 END AS lsn,
         1100000000000 + e.k * 8 + e.seq AS event_ms
  FROM oe0 e JOIN ow w ON w.k = e.k),
hv0 AS (
  SELECT *, row_number() OVER w AS version, count(*) OVER (PARTITION BY k) AS total,
         max(changed_ms) OVER (PARTITION BY k ORDER BY lsn, kafka_offset
                               ROWS UNBOUNDED PRECEDING) AS start_ms
  FROM oe WHERE seq <= 4 WINDOW w AS (PARTITION BY k ORDER BY lsn, kafka_offset)),
hv AS (
  SELECT *, lead(start_ms) OVER (PARTITION BY k ORDER BY lsn, kafka_offset) AS next_ms
  FROM hv0),
hk0 AS (
  SELECT *, row_number() OVER w AS version, count(*) OVER (PARTITION BY k) AS total,
         max(changed_ms) OVER (PARTITION BY k ORDER BY lsn, kafka_offset
                               ROWS UNBOUNDED PRECEDING) AS start_ms
  FROM oe WHERE seq <> 5 WINDOW w AS (PARTITION BY k ORDER BY lsn, kafka_offset)),
hk AS (
  SELECT *, lead(start_ms) OVER (PARTITION BY k ORDER BY lsn, kafka_offset) AS next_ms
  FROM hk0),
hc0 AS (
  SELECT *, sum(CASE WHEN op <> 'delete' THEN 1 ELSE 0 END)
              OVER (PARTITION BY k ORDER BY lsn, kafka_offset ROWS UNBOUNDED PRECEDING) AS opened
  FROM oe WHERE seq <> 5),
hcd AS (SELECT k, opened, min(event_ms) AS deleted_ms FROM hc0 WHERE op = 'delete' GROUP BY 1, 2),
hc1 AS (
  SELECT *, opened AS version, count(*) OVER (PARTITION BY k) AS total,
         max(changed_ms) OVER (PARTITION BY k ORDER BY lsn, kafka_offset
                               ROWS UNBOUNDED PRECEDING) AS start_ms
  FROM hc0 WHERE op <> 'delete'),
hc AS (
  SELECT v.*, lead(start_ms) OVER (PARTITION BY v.k ORDER BY lsn, kafka_offset) AS next_ms,
         d.deleted_ms
  FROM hc1 v LEFT JOIN hcd d ON d.k = v.k AND d.opened = v.opened),
hcv AS (
  SELECT order_id, k, CAST(version AS BIGINT) AS version, status, start_ms AS valid_from,
         CASE WHEN deleted_ms IS NOT NULL
              THEN least(coalesce(next_ms, {OPEN_END_MS}), greatest(deleted_ms, start_ms))
              ELSE coalesce(next_ms, {OPEN_END_MS}) END AS valid_to,
         next_ms IS NULL AND deleted_ms IS NULL AS is_current,
         deleted_ms IS NOT NULL AS is_deleted, changed_ms < start_ms AS is_clamped, total,
         approved_ms, shipped_ms, purchased_ms
  FROM hc),
ad AS (
  SELECT customer_unique_id, c, k, purchased_ms, order_id,
         c * 7 + CASE WHEN c % 10 = 0 AND k % 4 = 0 THEN 1 ELSE 0 END AS z FROM ow),
adt AS (
  SELECT *, lpad(CAST(z AS VARCHAR), 8, '0') AS zip_code_prefix,
         'city ' || (z % 50) AS city, lpad(CAST(z % 27 AS VARCHAR), 2, '0') AS state,
         lag(z) OVER (PARTITION BY c ORDER BY purchased_ms, k) AS pz,
         row_number() OVER (PARTITION BY c ORDER BY purchased_ms, k) AS visit FROM ad),
ce AS (
  SELECT *, CASE WHEN visit = 1 THEN 'read' ELSE 'update' END AS op,
         CASE WHEN visit = 1 THEN 0 ELSE purchased_ms END AS lsn,
         lpad(CAST(pz AS VARCHAR), 8, '0') AS prev_zip_code_prefix,
         'city ' || (pz % 50) AS prev_city,
         lpad(CAST(pz % 27 AS VARCHAR), 2, '0') AS prev_state,
         row_number() OVER (PARTITION BY c ORDER BY purchased_ms, k) AS version,
         count(*) OVER (PARTITION BY c) AS total,
         lead(purchased_ms) OVER (PARTITION BY c ORDER BY purchased_ms, k) AS next_ms
  FROM adt WHERE visit = 1 OR z <> pz),
cv AS (
  SELECT md5(customer_unique_id || '-' || version) AS customer_key, customer_unique_id, c,
         version, zip_code_prefix, city, state, purchased_ms AS valid_from,
         coalesce(next_ms, {OPEN_END_MS}) AS valid_to, next_ms IS NULL AS is_current,
         total > 1 AS has_history, 1100000000000 + k AS cdc_observed_at
  FROM ce),
it AS (
  SELECT l_orderkey AS k, CAST(l_orderkey AS VARCHAR) AS order_id,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
           l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax,
           l_returnflag, l_linestatus) AS order_item_id,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
         epoch_ms(l_shipdate) AS shipping_limit_at,
         CAST(l_extendedprice AS DECIMAL(10, 2)) AS price,
         CAST(((l_partkey * 37) % 5000) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(10, 2)) AS freight
  FROM lineitem),
pr AS (
  SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS product_id,
         CASE WHEN p_partkey % 54 <> 0 THEN p_type END AS category_name,
         CASE WHEN p_partkey % 54 <> 0 AND p_type <> 'PROMO' THEN lower(p_type) END
           AS category_name_en,
         CAST(CASE WHEN p_partkey % 211 <> 0 THEN p_size * 100 END AS BIGINT) AS weight_g,
         CAST(p_size + 10 AS BIGINT) AS length_cm, CAST(p_size + 5 AS BIGINT) AS height_cm,
         CAST(p_size + 7 AS BIGINT) AS width_cm FROM part),
se0 AS (
  SELECT l_suppkey AS k, min(purchased_ms) AS first_ms
  FROM lineitem JOIN ow ON ow.k = l_orderkey GROUP BY 1),
se AS (
  SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS seller_id,
         lpad(CAST(s_suppkey * 13 AS VARCHAR), 8, '0') AS zip_code_prefix, s_name AS city,
         lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS state,
         coalesce(first_ms, 1472688000000) AS updated_at
  FROM supplier LEFT JOIN se0 ON se0.k = s_suppkey),
ocr AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY lsn DESC, kafka_offset DESC) AS rn
  FROM oe WHERE seq <= 5),
oc AS (SELECT * FROM ocr WHERE rn = 1),
odr AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY lsn DESC, kafka_offset DESC) AS rn
  FROM oe),
od AS (SELECT * FROM odr WHERE rn = 1 AND op <> 'delete'),
ocv AS (
  SELECT o.*, v.customer_key, v.version AS customer_version
  FROM oc o LEFT JOIN cv v ON v.customer_unique_id = o.customer_unique_id
   AND o.purchased_ms >= v.valid_from AND o.purchased_ms < v.valid_to),
odv AS (
  SELECT o.*, v.customer_key, v.is_current AS at_current
  FROM od o LEFT JOIN cv v ON v.customer_unique_id = o.customer_unique_id
   AND o.purchased_ms >= v.valid_from AND o.purchased_ms < v.valid_to),
items_per AS (
  SELECT order_id, count(*) AS item_count, count(DISTINCT seller_id) AS seller_count,
         count(DISTINCT product_id) AS product_count, sum(price) AS gross_price,
         sum(freight) AS gross_freight, sum(price + freight) AS order_total
  FROM it GROUP BY 1),
logk AS (
  SELECT 'order' AS source_table, order_id AS pk, op, kafka_offset FROM oe
  UNION ALL SELECT 'customer', customer_unique_id, op, k FROM ce
  UNION ALL SELECT 'product', product_id, 'read', k FROM pr
  UNION ALL SELECT 'seller', seller_id, 'read', k FROM se
  UNION ALL SELECT 'order_item', order_id || ':' || order_item_id, 'read',
                   k * 16777216 + order_item_id FROM it),
ue AS (SELECT user_id, event_id, epoch_us(ts) AS us, event_type FROM events),
ub AS (SELECT CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, event_id, us,
              event_type FROM ue),
uh0 AS (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM ue),
uh AS (
  SELECT *, row_number() OVER w AS version, count(*) OVER (PARTITION BY user_id) AS total,
         lead(us) OVER w AS next_us
  FROM uh0 WHERE p IS DISTINCT FROM event_type WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
bh0 AS (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM ub),
bh AS (
  SELECT *, row_number() OVER w AS version, count(*) OVER (PARTITION BY user_id) AS total,
         lead(us) OVER w AS next_us
  FROM bh0 WHERE p IS DISTINCT FROM event_type WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
"""

USER_VERSIONS = f"""
SELECT user_id, version, event_type, next_us IS NULL AS is_current, total > 1 AS has_history,
       total AS total_versions, us AS valid_from_us,
       coalesce(next_us, {OPEN_END_MS * 1000}) AS valid_to_us FROM """

STATUS_VERSIONS_CLOSE = """
SELECT order_id, version, status AS order_status, valid_from, valid_to, is_current, is_deleted,
       CASE WHEN NOT is_current
            THEN CAST(floor(valid_to / 1000.0) - floor(valid_from / 1000.0) AS BIGINT)
       END AS seconds_in_status,
       is_clamped AS is_timestamp_clamped, total AS total_status_versions FROM hcv"""

LATEST = "SELECT order_id, status AS order_status, lsn, kafka_offset FROM od"

STATE_AT_EVENT = """
SELECT f.user_id, f.event_id, v.version, v.event_type AS state
FROM ub f LEFT JOIN bh v ON v.user_id = f.user_id AND f.us >= v.us
 AND (v.next_us IS NULL OR f.us < v.next_us)"""

OFFSET_GAPS = """
SELECT 'commerce.commerce.order' AS topic, CAST(0 AS BIGINT) AS partition, kafka_offset, previous,
       kafka_offset - previous - 1 AS missing
FROM (SELECT kafka_offset, lag(kafka_offset) OVER (ORDER BY kafka_offset) AS previous FROM oe)
WHERE kafka_offset - previous > 1"""


def _fct_orders(current: str, history: str) -> str:
    return f"""
SELECT o.order_id, o.customer_unique_id, o.status AS order_status, o.purchased_ms AS purchased_at,
       o.approved_ms AS approved_at, o.shipped_ms AS shipped_at, o.delivered_ms AS delivered_at,
       strftime(make_timestamp(o.estimated_ms * 1000), '%Y-%m-%d') AS estimated_delivery_date,
       strftime(make_timestamp(o.purchased_ms * 1000), '%Y-%m-%d') AS purchased_date,
       coalesce(i.item_count, 0) AS item_count, coalesce(i.seller_count, 0) AS seller_count,
       coalesce(i.product_count, 0) AS product_count,
       CAST(i.gross_price AS DOUBLE) AS gross_price,
       CAST(i.gross_freight AS DOUBLE) AS gross_freight,
       CAST(i.order_total AS DOUBLE) AS order_total,
       h.status_versions, i.order_id IS NULL AS is_missing_items,
       o.status = 'delivered' AS is_delivered,
       o.status IN ('canceled', 'unavailable') AS is_terminated,
       CASE WHEN o.delivered_ms IS NOT NULL
            THEN o.delivered_ms // 86400000 > o.estimated_ms // 86400000 END AS is_delivered_late,
       CASE WHEN o.delivered_ms IS NOT NULL
            THEN o.delivered_ms // 86400000 - o.purchased_ms // 86400000 END AS days_to_deliver,
       h.inverted > 0 AS has_inverted_timestamps, h.instant > 0 AS has_instant_approval
FROM {current} o LEFT JOIN items_per i ON i.order_id = o.order_id
LEFT JOIN (
  SELECT order_id, max(total) AS status_versions,
         count(*) FILTER (shipped_ms < approved_ms) AS inverted,
         count(*) FILTER (approved_ms = purchased_ms) AS instant
  FROM {history} GROUP BY 1) h ON h.order_id = o.order_id"""


CSV_ORDERS = """
SELECT lpad(order_id, 10, '0') AS order_id, customer_id, final_status AS order_status,
       purchased_ms AS order_purchase_timestamp, approved_ms AS order_approved_at,
       shipped_ms AS order_delivered_carrier_date, delivered_ms AS order_delivered_customer_date,
       estimated_ms AS order_estimated_delivery_date FROM ow"""

CUSTOMER_LOG = """
SELECT 'customer' AS source_table, op, CASE WHEN op = 'update' THEN lsn END AS lsn,
       k AS kafka_offset, customer_unique_id AS pk FROM ce"""

SELECTS = {
    "revenue_by_version_address": """
SELECT v.state, count(*) AS items, count(*) FILTER (NOT v.is_current) AS items_at_former_address,
       CAST(sum(i.price) AS DOUBLE) AS revenue, CAST(sum(i.freight) AS DOUBLE) AS freight
FROM it i JOIN ocv o ON o.order_id = i.order_id LEFT JOIN cv v ON v.customer_key = o.customer_key
GROUP BY 1""",
    "log_summary": """
SELECT coalesce(source_table, '(all)') AS source_table, coalesce(op, '(all)') AS op,
       count(*) AS events
FROM logk GROUP BY CUBE (source_table, op)""",
    "log_primary_keys": "SELECT source_table, pk, kafka_offset FROM logk",
    "decoded_order_messages": """
SELECT 'order' AS source_table, op, raw_lsn AS lsn, k AS tx_id, event_ms AS event_ts_ms,
       seq = 0 AS is_snapshot, 'commerce.commerce.order' AS topic, kafka_offset, order_id AS pk,
       prev AS status_before, status AS status_after FROM oe""",
    "rejected_messages": """
SELECT CASE k % 500 WHEN 1 THEN 'malformed message' WHEN 2 THEN 'no operation'
            WHEN 5 THEN 'no business key' WHEN 6 THEN 'no row image'
            WHEN 8 THEN 'no source table'
            ELSE 'no observation time' END AS problem, kafka_offset
FROM oe WHERE seq = 0 AND k % 500 IN (1, 2, 5, 6, 7, 8)""",
    "gate_with_quarantine": """
SELECT 'quarantine_is_empty' AS "check", count(*) AS violations
FROM oe WHERE seq = 0 AND k % 500 IN (1, 2, 5, 6, 7, 8)""",
    "log_append_between_tails": CUSTOMER_LOG,
    "log_rebuild_then_tail": CUSTOMER_LOG,
    "log_repeated_positions": CUSTOMER_LOG,
    "log_concurrent_writers": CUSTOMER_LOG,
    "log_rebuild_while_tailing": CUSTOMER_LOG,
    "log_after_compaction": CUSTOMER_LOG,
    "log_offset_gaps": """
SELECT previous, kafka_offset, kafka_offset - previous - 1 AS missing FROM (
  SELECT k AS kafka_offset, lag(k) OVER (ORDER BY k) AS previous FROM ce WHERE k % 9 <> 0)
WHERE kafka_offset > previous + 1""",
    "csv_mixed_headers": CSV_ORDERS,
    "csv_orders": CSV_ORDERS,
    "stg_customer_events": """
SELECT customer_unique_id, op, op = 'read' AS is_snapshot, 1100000000000 + k AS event_at,
       purchased_ms AS changed_at, zip_code_prefix, city, state, prev_zip_code_prefix, prev_city,
       prev_state, lsn, k AS kafka_offset, k AS tx_id, version AS event_seq,
       FALSE AS is_no_op_update FROM ce""",
    "stg_order_events": """
SELECT order_id, customer_id, customer_unique_id, status AS order_status,
       prev AS prev_order_status, op, seq = 0 AS is_snapshot, event_ms AS event_at,
       changed_ms AS changed_at, purchased_ms AS purchased_at, approved_ms AS approved_at,
       shipped_ms AS shipped_at, delivered_ms AS delivered_at,
       strftime(make_timestamp(estimated_ms * 1000), '%Y-%m-%d') AS estimated_delivery_date,
       lsn, kafka_offset, k AS tx_id,
       row_number() OVER (PARTITION BY k ORDER BY lsn, kafka_offset) AS event_seq,
       seq = 5 AS is_no_op_update FROM oe""",
    "stg_order_items": """
SELECT order_id, order_item_id, product_id, seller_id, CAST(price AS DOUBLE) AS price,
       CAST(freight AS DOUBLE) AS freight_value, shipping_limit_at FROM it""",
    "stg_products": """
SELECT product_id, category_name, category_name_en, weight_g, length_cm, height_cm, width_cm
FROM pr""",
    "stg_sellers": "SELECT seller_id, zip_code_prefix, city, state FROM se",
    "int_orders_current": """
SELECT order_id, customer_id, customer_unique_id, status AS order_status,
       purchased_ms AS purchased_at, approved_ms AS approved_at, shipped_ms AS shipped_at,
       delivered_ms AS delivered_at,
       strftime(make_timestamp(estimated_ms * 1000), '%Y-%m-%d') AS estimated_delivery_date,
       event_ms AS last_changed_at FROM od""",
    "latest_state_agg": LATEST,
    "latest_state_resurrected": """
SELECT o.order_id, count(*) AS deletes, o.k % 202 = 9 AS is_live,
       CASE WHEN o.k % 202 = 9 THEN 'created' END AS order_status
FROM oe o WHERE op = 'delete' GROUP BY o.order_id, o.k""",
    "dim_customer": """
SELECT customer_key, customer_unique_id, version, zip_code_prefix, city, state, valid_from,
       valid_to, is_current, FALSE AS is_deleted, has_history, cdc_observed_at FROM cv""",
    "dim_order_status_history": f"""
SELECT md5(order_id || '-' || version) AS order_status_key, order_id, customer_unique_id, version,
       status AS order_status, prev AS prev_order_status, start_ms AS valid_from,
       coalesce(next_ms, {OPEN_END_MS}) AS valid_to, next_ms IS NULL AS is_current,
       FALSE AS is_deleted, next_ms // 1000 - start_ms // 1000 AS seconds_in_status,
       coalesce(next_ms = start_ms, FALSE) AS is_instantaneous,
       changed_ms < start_ms AS is_timestamp_clamped, changed_ms AS raw_changed_at,
       event_ms AS cdc_observed_at, purchased_ms AS purchased_at, approved_ms AS approved_at,
       shipped_ms AS shipped_at, delivered_ms AS delivered_at,
       coalesce(approved_ms < purchased_ms, FALSE) AS is_approved_before_purchase,
       coalesce(shipped_ms < approved_ms, FALSE) AS is_shipped_before_approved,
       coalesce(delivered_ms < shipped_ms, FALSE) AS is_delivered_before_shipped,
       coalesce(approved_ms = purchased_ms, FALSE) AS is_approved_at_purchase_instant,
       total AS total_status_versions FROM hv""",
    "scd2_on_delete_close": STATUS_VERSIONS_CLOSE,
    "scd2_on_delete_keep": f"""
SELECT order_id, version, status AS order_status, start_ms AS valid_from,
       coalesce(next_ms, {OPEN_END_MS}) AS valid_to, next_ms IS NULL AS is_current,
       FALSE AS is_deleted, next_ms // 1000 - start_ms // 1000 AS seconds_in_status,
       coalesce(changed_ms < start_ms, FALSE) AS is_timestamp_clamped,
       total AS total_status_versions FROM hk""",
    "user_state_history": USER_VERSIONS + "uh",
    "user_state_history_hot_key": USER_VERSIONS + "bh",
    "dim_product": """
SELECT md5(product_id) AS product_key, product_id,
       coalesce(category_name, 'unknown') AS category_name,
       coalesce(category_name_en, 'unknown') AS category_name_en,
       category_name IS NULL AS is_category_missing, weight_g, length_cm, height_cm, width_cm
FROM pr""",
    "dim_seller": """
SELECT md5(seller_id) AS seller_key, seller_id, zip_code_prefix, city, state FROM se""",
    "fct_orders": _fct_orders("oc", "hv"),
    "fct_orders_after_deletes": _fct_orders("od", "hcv"),
    "fct_order_items": """
SELECT md5(i.order_id || '-' || i.order_item_id) AS order_item_key, i.order_id, i.order_item_id,
       coalesce(o.customer_key, '_unmatched') AS customer_key, md5(p.product_id) AS product_key,
       md5(s.seller_id) AS seller_key, o.customer_unique_id, o.status AS order_status,
       CAST(i.price AS DOUBLE) AS price, CAST(i.freight AS DOUBLE) AS freight_value,
       CAST(i.price + i.freight AS DOUBLE) AS item_total, o.purchased_ms AS purchased_at,
       o.approved_ms AS approved_at, o.shipped_ms AS shipped_at, o.delivered_ms AS delivered_at,
       strftime(make_timestamp(o.estimated_ms * 1000), '%Y-%m-%d') AS estimated_delivery_date,
       strftime(make_timestamp(o.purchased_ms * 1000), '%Y-%m-%d') AS purchased_date,
       CASE WHEN o.delivered_ms IS NOT NULL
            THEN o.delivered_ms // 86400000 > o.estimated_ms // 86400000 END AS is_delivered_late,
       o.customer_key IS NULL AS is_customer_version_unmatched
FROM it i JOIN ocv o ON o.order_id = i.order_id LEFT JOIN pr p ON p.product_id = i.product_id
LEFT JOIN se s ON s.seller_id = i.seller_id""",
    "as_of_join_range": """
SELECT order_id, customer_unique_id, purchased_ms AS purchased_at, customer_key, customer_version
FROM ocv""",
    "as_of_join_window": """
SELECT order_id, customer_unique_id, purchased_ms AS purchased_at, customer_key, customer_version
FROM ocv""",
    "as_of_join_range_hot_key": STATE_AT_EVENT,
    "as_of_join_window_hot_key": STATE_AT_EVENT,
    "lifecycle": """
SELECT order_id, row_number() OVER (PARTITION BY k ORDER BY seq) AS seq, status,
       CASE WHEN seq <= 3 THEN changed_ms END AS at_ms, seq = 4 AS is_terminal_hop,
       seq <= 3 AND coalesce(changed_ms < lag(changed_ms) OVER (PARTITION BY k ORDER BY seq), FALSE)
         AS is_out_of_order
FROM oe WHERE seq BETWEEN 1 AND 4""",
    "terminal_hops": """
SELECT order_id, seq, status, at_ms FROM (
  SELECT order_id, row_number() OVER (PARTITION BY k ORDER BY seq) AS seq, status,
         changed_ms AS at_ms, seq AS position
  FROM oe WHERE seq BETWEEN 1 AND 4) WHERE position = 4""",
    "out_of_order_steps": """
SELECT count(*) AS out_of_order FROM (
  SELECT changed_ms < lag(changed_ms) OVER (PARTITION BY k ORDER BY seq) AS is_early
  FROM oe WHERE seq BETWEEN 1 AND 3) WHERE is_early""",
    "transitions_per_status": """
SELECT status, count(*) AS transitions FROM oe WHERE seq BETWEEN 1 AND 4 GROUP BY 1""",
    "address_changes": """
SELECT customer_unique_id, zip_code_prefix, city, state, purchased_ms FROM adt
WHERE pz IS NOT NULL AND z <> pz ORDER BY purchased_ms""",
    "initial_customers": """
SELECT customer_unique_id, zip_code_prefix, city, state, purchased_ms AS updated_ms
FROM adt WHERE visit = 1""",
    "seller_anchor": "SELECT seller_id, zip_code_prefix, city, state, updated_at FROM se",
    "product_translation": """
SELECT product_id, category_name, weight_g, length_cm, height_cm, width_cm,
       1472688000000 AS updated_at, category_name_en FROM pr""",
    "orders_rewound": """
SELECT order_id, customer_id, customer_unique_id, 'created' AS order_status, purchased_ms,
       CAST(NULL AS BIGINT) AS approved_ms, CAST(NULL AS BIGINT) AS shipped_ms,
       CAST(NULL AS BIGINT) AS delivered_ms, estimated_ms, purchased_ms AS updated_ms FROM ow""",
    "rewound_not_created": """
SELECT 'before' AS state, count(*) AS not_created FROM ow WHERE final_status <> 'created'
UNION ALL SELECT 'after', 0""",
    "items_initial": """
SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_at,
       CAST(i.price AS DOUBLE) AS price, CAST(i.freight AS DOUBLE) AS freight_value,
       o.purchased_ms AS updated_at FROM it i JOIN ow o ON o.k = i.k""",
    "hash_sample_10pct": """
SELECT order_id, final_status FROM ow
WHERE CAST('0x' || substr(md5(order_id), 1, 8) AS BIGINT) % 100 < 10""",
    "status_distribution_drift": """
SELECT coalesce(a.s, e.s) AS order_status, coalesce(a.n, 0) AS actual,
       coalesce(e.n, 0) AS expected, coalesce(a.n, 0) - coalesce(e.n, 0) AS drift
FROM (SELECT status AS s, count(*) AS n FROM od GROUP BY 1) a
FULL JOIN (SELECT final_status AS s, count(*) AS n FROM ow GROUP BY 1) e ON e.s = a.s
ORDER BY actual DESC""",
    "status_total_drift": """
SELECT CAST(sum(abs(coalesce(a.n, 0) - coalesce(e.n, 0))) AS BIGINT) AS total_drift
FROM (SELECT status AS s, count(*) AS n FROM od GROUP BY 1) a
FULL JOIN (SELECT final_status AS s, count(*) AS n FROM ow GROUP BY 1) e ON e.s = a.s""",
    "replayed_status_history": f"""
SELECT order_id, version, status AS order_status, start_ms AS valid_from,
       coalesce(next_ms, {OPEN_END_MS}) AS valid_to, next_ms IS NULL AS is_current,
       FALSE AS is_deleted, next_ms // 1000 - start_ms // 1000 AS seconds_in_status,
       changed_ms < start_ms AS is_timestamp_clamped, total AS total_status_versions FROM hv""",
    "replayed_customer_history": """
SELECT customer_key, customer_unique_id, version, zip_code_prefix, city, state, valid_from,
       valid_to, is_current, FALSE AS is_deleted, has_history FROM cv""",
    "replayed_items": """
SELECT md5(i.order_id || '-' || i.order_item_id) AS order_item_key, i.order_id, i.order_item_id,
       o.customer_key, md5(i.product_id) AS product_key, md5(i.seller_id) AS seller_key,
       w.final_status AS order_status, CAST(i.price + i.freight AS DOUBLE) AS item_total,
       w.purchased_ms AS purchased_at
FROM it i JOIN ow w ON w.k = i.k JOIN ocv o ON o.k = i.k""",
    "replayed_status_drift": """
SELECT final_status AS order_status, count(*) AS actual, count(*) AS expected,
       CAST(0 AS BIGINT) AS drift FROM ow GROUP BY 1""",
    "dq_not_null": "SELECT order_id FROM oc WHERE approved_ms IS NULL",
    "dq_unique": """
SELECT customer_unique_id, count(*) AS rows FROM oc GROUP BY 1 HAVING count(*) > 1""",
    "dq_unique_combination": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS rows
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_accepted_values": """
SELECT order_id, status AS order_status FROM oc WHERE status IN ('canceled', 'unavailable')""",
    "dq_relationships": """
SELECT order_id, count(*) AS rows FROM it
WHERE order_id NOT IN (SELECT order_id FROM od) GROUP BY 1""",
    "dq_expression": """
SELECT order_id, version, status AS order_status FROM hv
WHERE next_ms // 1000 - start_ms // 1000 <= 0""",
    "dq_range": """
SELECT order_id, order_item_id, CAST(freight AS DOUBLE) AS freight_value FROM it
WHERE freight <= 0""",
    "dq_one_current": """
SELECT 'dim_order_status_history' AS model, business_key, n AS current_versions FROM (
  SELECT order_id AS business_key, arg_max(is_deleted, version) AS gone,
         count(*) FILTER (is_current OR (k % 500 = 3 AND version = 1)) AS n
  FROM hcv GROUP BY 1) WHERE n <> CASE WHEN gone THEN 0 ELSE 1 END""",
    "dq_tiling": """
SELECT 'dim_order_status_history' AS model, order_id AS business_key, version, valid_to,
       next_valid_from FROM (
  SELECT order_id, version, is_deleted,
         valid_to + CASE WHEN k % 500 = 3 AND NOT is_current THEN 1 ELSE 0 END AS valid_to,
         lead(valid_from) OVER (PARTITION BY k ORDER BY version) AS next_valid_from
  FROM hcv)
WHERE valid_to <> next_valid_from AND NOT (is_deleted AND valid_to <= next_valid_from)""",
    "dq_no_fan_out": """
SELECT o.order_id, count(v.version) AS matched_versions
FROM oc o LEFT JOIN cv v ON v.customer_unique_id = o.customer_unique_id
 AND o.purchased_ms >= v.valid_from + CASE WHEN v.version = 1 THEN 1000 ELSE 0 END
 AND o.purchased_ms < v.valid_to + CASE WHEN v.is_current THEN 0 ELSE 2592000000 END
GROUP BY 1 HAVING count(v.version) <> 1""",
    "dq_versions_match": """
SELECT e.customer_unique_id, e.n AS changing_events, v.n AS versions
FROM (SELECT customer_unique_id, count(*) AS n FROM ce GROUP BY 1) e
FULL JOIN (SELECT customer_unique_id, count(*) AS n FROM cv
           WHERE NOT (version = 2 AND c % 20 = 0) GROUP BY 1) v
  ON v.customer_unique_id = e.customer_unique_id
WHERE e.n IS DISTINCT FROM v.n""",
    "dq_generations": """
SELECT 'order' AS source_table, order_id AS pk, count(*) AS snapshot_reads FROM (
  SELECT order_id FROM oe WHERE op = 'read'
  UNION ALL SELECT order_id FROM oe WHERE op = 'read' AND k % 500 = 1)
GROUP BY 2 HAVING count(*) > 1""",
    "dq_deleted": """
SELECT 'wrong_orders' AS model, order_id AS pk FROM odr WHERE rn = 1 AND op = 'delete'""",
    "dq_fact_reconcile": """
SELECT (SELECT count(*) FROM od) AS log_keys, (SELECT count(*) FROM ow) AS fact_rows
WHERE (SELECT count(*) FROM od) <> (SELECT count(*) FROM ow)""",
    "dq_items_reconcile": """
SELECT o.order_id, coalesce(i.item_count, 0) AS declared, coalesce(a.n, 0) AS actual
FROM oc o LEFT JOIN items_per i ON i.order_id = o.order_id
LEFT JOIN (SELECT order_id, count(*) AS n FROM it
           WHERE NOT (k % 500 = 3 AND order_item_id = 1) GROUP BY 1) a ON a.order_id = o.order_id
WHERE coalesce(i.item_count, 0) <> coalesce(a.n, 0)""",
    "dq_counts": """
SELECT relation, expected, actual FROM (
  SELECT 'fct_orders' AS relation, (SELECT count(*) FROM orders) AS expected,
         (SELECT count(*) FROM od) AS actual
  UNION ALL SELECT 'fct_order_items', (SELECT count(*) FROM lineitem),
         (SELECT count(*) FROM it JOIN od ON od.order_id = it.order_id)
  UNION ALL SELECT 'dim_product', (SELECT count(*) FROM part), (SELECT count(*) FROM pr)
  UNION ALL SELECT 'dim_seller', (SELECT count(*) FROM supplier), (SELECT count(*) FROM se))
WHERE expected <> actual""",
    "dq_invariants": """
SELECT invariant, CAST(expected AS DOUBLE) AS expected, CAST(actual AS DOUBLE) AS actual FROM (
  SELECT 'revenue to the cent' AS invariant, (SELECT sum(price) FROM it) AS expected,
         (SELECT sum(price) FROM it JOIN od ON od.order_id = it.order_id) AS actual
  UNION ALL SELECT 'orders without items',
         (SELECT count(*) FROM ow WHERE order_id NOT IN (SELECT order_id FROM it)),
         (SELECT count(*) FROM od WHERE order_id NOT IN (SELECT order_id FROM it))
  UNION ALL SELECT 'customers with history', 0,
         (SELECT count(DISTINCT customer_unique_id) FROM cv WHERE has_history)
  UNION ALL SELECT 'items at a former address', 0,
         (SELECT count(*) FROM it JOIN odv ON odv.order_id = it.order_id WHERE NOT at_current)
  UNION ALL SELECT 'customers without one current version', 0,
         (SELECT count(*) FROM (SELECT c FROM cv GROUP BY 1
                                HAVING count(*) FILTER (is_current) <> 1))
  UNION ALL SELECT 'windows running backwards', 0,
         (SELECT count(*) FROM hcv WHERE valid_to < valid_from))
WHERE expected <> actual""",
    "dq_log_vs_source": """
SELECT source_table, events, updates, deletes, rows, rows + updates + 2 * deletes AS expected
FROM (SELECT source_table, count(*) AS events, count(*) FILTER (op = 'update') AS updates,
             count(*) FILTER (op = 'delete') AS deletes FROM logk GROUP BY 1)
JOIN (SELECT 'order' AS source_table, count(*) AS rows FROM orders
      UNION ALL SELECT 'order_item', count(*) FROM lineitem
      UNION ALL SELECT 'product', count(*) FROM part
      UNION ALL SELECT 'seller', count(*) FROM supplier
      UNION ALL SELECT 'customer', count(DISTINCT o_custkey) FROM orders) USING (source_table)
WHERE events <> rows + updates + 2 * deletes""",
    "dq_op_mix": """
SELECT source_table, op, count(*) AS events, source_table <> 'order' AS is_reconciled
FROM logk GROUP BY 1, 2""",
    "dq_lsn": """
SELECT order_id AS pk, op, kafka_offset FROM oe WHERE seq = 1 AND k % 500 = 2""",
    "dq_offset_gaps": OFFSET_GAPS,
    "dq_offset_gaps_hot_key": OFFSET_GAPS,
    "dq_order_key": """
SELECT 'backwards' AS problem, 'commerce.commerce.customer' AS topic,
       CAST(0 AS BIGINT) AS partition, lsn, CAST(1 AS BIGINT) AS events FROM (
  SELECT lsn, lag(lsn) OVER (ORDER BY k) AS p FROM ce WHERE op = 'update') WHERE lsn < p
UNION ALL
SELECT 'collision', 'commerce.commerce.customer', 0, lsn, count(*) FROM ce WHERE op = 'update'
GROUP BY lsn HAVING count(*) > 1
UNION ALL
SELECT 'collision', 'commerce.commerce.order', 0, lsn, count(*) FROM (
  SELECT CASE WHEN seq = 2 THEN lsn - 1 ELSE lsn END AS lsn FROM oe WHERE seq > 0)
GROUP BY lsn HAVING count(*) > 1""",
    "profile_findings": """
SELECT 'orders.rows' AS finding, count(*) AS value FROM oc
UNION ALL SELECT 'orders.distinct_keys', count(DISTINCT c) FROM ow
UNION ALL SELECT 'orders.repeated_keys',
  (SELECT count(*) FROM (SELECT c FROM ow GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'orders.null_approved_at', count(*) FROM oc WHERE approved_ms IS NULL
UNION ALL SELECT 'orders.null_delivered_at', count(*) FROM oc WHERE delivered_ms IS NULL
UNION ALL SELECT 'products.rows', count(*) FROM pr
UNION ALL SELECT 'products.distinct_keys', count(DISTINCT product_id) FROM pr
UNION ALL SELECT 'products.repeated_keys', 0
UNION ALL SELECT 'products.null_category_name', count(*) FROM pr WHERE category_name IS NULL
UNION ALL SELECT 'address_changes', count(*) FROM cv WHERE NOT is_current
UNION ALL SELECT 'orders_without_items', count(*) FROM ow
  WHERE order_id NOT IN (SELECT order_id FROM it)
UNION ALL SELECT 'orders_with_inverted_times', count(DISTINCT k) FROM hv
  WHERE shipped_ms < approved_ms
UNION ALL SELECT 'orders_approved_at_purchase', count(DISTINCT k) FROM hv
  WHERE approved_ms = purchased_ms
UNION ALL SELECT 'clamped_versions', count(*) FROM hv WHERE changed_ms < start_ms""",
    "cdc_latency": """
SELECT op, count(*) AS events, min(ms) AS min_ms, max(ms) AS max_ms,
       CAST(sum(ms) AS BIGINT) AS sum_ms,
       quantile_disc(ms // 86400000, 0.5) AS p50_units,
       quantile_disc(ms // 86400000, 0.95) AS p95_units,
       quantile_disc(ms // 86400000, 0.99) AS p99_units
FROM (SELECT op, event_ms - changed_ms AS ms FROM oe WHERE changed_ms IS NOT NULL)
GROUP BY 1""",
    "stream_log_roundtrip": """
SELECT 'order' AS source_table, op, raw_lsn AS lsn, kafka_offset, order_id AS pk,
       seq = 0 AS is_snapshot FROM oe
UNION ALL
SELECT 'customer', op, CASE WHEN op = 'update' THEN lsn END, k, customer_unique_id, op = 'read'
FROM ce""",
    "stream_scd2_incremental": STATUS_VERSIONS_CLOSE,
    "stream_latest_state": LATEST,
    "stream_latest_after_rebuild": LATEST,
    "stream_latency_sketch": """
SELECT op, count(*) AS events, min(ms) AS min_ms, max(ms) AS max_ms, CAST(sum(ms) AS BIGINT) AS sum_ms,
       TRUE AS p50_ms_is_close, TRUE AS p95_ms_is_close, TRUE AS p99_ms_is_close
FROM (SELECT op, event_ms - changed_ms AS ms FROM oe WHERE changed_ms IS NOT NULL) GROUP BY 1""",
}


# The delete-free log and the models as tables, for the declared checks.
GATE_TABLES = f"""
cdc_events AS (
  SELECT source_table, pk, op, kafka_offset, op = 'read' AS is_snapshot,
         CASE WHEN op <> 'read' THEN kafka_offset END AS lsn
  FROM logk WHERE source_table <> 'order'
  UNION ALL SELECT 'order', order_id, op, kafka_offset, seq = 0, raw_lsn FROM oe WHERE seq <= 5),
stg_order_events AS (SELECT * FROM ({SELECTS["stg_order_events"]}) WHERE op NOT IN ('insert', 'delete')),
int_orders_current AS (
  SELECT order_id, status AS order_status, customer_unique_id, purchased_ms AS purchased_at FROM oc),
""" + ",\n".join(
    f"{name} AS ({SELECTS[name]})"
    for name in (
        "stg_customer_events", "stg_order_items", "stg_products", "stg_sellers", "dim_customer",
        "dim_order_status_history", "dim_product", "dim_seller", "fct_orders", "fct_order_items",
    )
)


def _tiling(model: str, key: str) -> str:
    return f"""SELECT 1 FROM (SELECT valid_to, lead(valid_from) OVER (
        PARTITION BY {key} ORDER BY version) AS following FROM {model}) WHERE valid_to <> following"""


def _not_one_current(model: str, key: str) -> str:
    return f"SELECT 1 FROM {model} GROUP BY {key} HAVING count(*) FILTER (is_current) <> 1"


NEWEST = """(SELECT source_table, pk, op, row_number() OVER (PARTITION BY source_table, pk
    ORDER BY coalesce(lsn, 0) DESC, kafka_offset DESC) AS rn FROM cdc_events)"""

SPANNING_CHECKS = {
    "no_duplicate_generations": """SELECT 1 FROM cdc_events WHERE op = 'read'
        GROUP BY source_table, pk HAVING count(*) > 1""",
    "deleted_rows_do_not_reappear": f"""SELECT 1 FROM {NEWEST} WHERE rn = 1 AND op = 'delete' AND pk IN (
        SELECT order_id FROM fct_orders UNION ALL SELECT product_id FROM dim_product
        UNION ALL SELECT seller_id FROM dim_seller
        UNION ALL SELECT order_id || ':' || order_item_id FROM fct_order_items)""",
    "fct_orders_reconciles_to_log": f"""SELECT 1
        WHERE (SELECT count(*) FROM {NEWEST} WHERE source_table = 'order' AND rn = 1 AND op <> 'delete')
           <> (SELECT count(*) FROM fct_orders)""",
    "facts_reconcile": """SELECT 1 FROM fct_orders o LEFT JOIN (
        SELECT order_id, count(*) AS n FROM fct_order_items GROUP BY 1) i ON i.order_id = o.order_id
        WHERE o.item_count <> coalesce(i.n, 0)""",
    "exactly_one_current_version": _not_one_current("dim_customer", "customer_unique_id")
    + " UNION ALL " + _not_one_current("dim_order_status_history", "order_id"),
    "windows_have_no_gaps_or_overlaps": _tiling("dim_customer", "customer_unique_id")
    + " UNION ALL " + _tiling("dim_order_status_history", "order_id"),
    "as_of_join_does_not_fan_out": """SELECT 1 FROM int_orders_current o LEFT JOIN dim_customer c
        ON c.customer_unique_id = o.customer_unique_id
       AND o.purchased_at >= c.valid_from AND o.purchased_at < c.valid_to
        GROUP BY o.order_id HAVING count(c.version) <> 1""",
    "version_counts_match_log": """SELECT 1 FROM (
        SELECT customer_unique_id, count(*) AS n FROM stg_customer_events
        WHERE NOT is_no_op_update GROUP BY 1) e
        FULL JOIN (SELECT customer_unique_id, count(*) AS n FROM dim_customer GROUP BY 1) v
        ON v.customer_unique_id = e.customer_unique_id
        WHERE e.n IS DISTINCT FROM v.n""",
}


# --- fixed values: what is declared of each table, stated here once more ---------------
NOT_NULL = """cdc_events source_table op pk
stg_customer_events customer_unique_id event_seq city state
stg_order_events order_id order_status purchased_at event_seq
stg_order_items order_id order_item_id product_id seller_id price
stg_products product_id
stg_sellers seller_id
int_orders_current order_id order_status purchased_at customer_unique_id
dim_customer customer_key customer_unique_id version valid_from valid_to is_current
dim_order_status_history order_status_key order_id order_status valid_from valid_to
dim_seller seller_key seller_id
dim_product product_key product_id category_name
fct_orders order_id customer_unique_id order_status item_count status_versions
fct_order_items order_item_key order_id customer_key product_key seller_key price"""
UNIQUE = """stg_products product_id
stg_sellers seller_id
int_orders_current order_id
dim_customer customer_key
dim_order_status_history order_status_key
dim_seller seller_key seller_id
dim_product product_key product_id
fct_orders order_id
fct_order_items order_item_key"""
COMBINATIONS = """stg_customer_events customer_unique_id event_seq
stg_order_events order_id event_seq
stg_order_items order_id order_item_id
dim_customer customer_unique_id version
dim_order_status_history order_id version
fct_order_items order_id order_item_id"""
VALUES = """cdc_events source_table customer seller product order order_item
cdc_events op read insert update delete
stg_order_events order_status created approved invoiced processing shipped delivered unavailable canceled
dim_order_status_history order_status created approved invoiced processing shipped delivered unavailable canceled
fct_orders order_status created approved invoiced processing shipped delivered unavailable canceled"""
EXPRESSIONS = {
    "streamed_events_have_lsn": ("cdc_events", "lsn IS NOT NULL OR is_snapshot"),
    "windows_have_positive_width": ("dim_customer", "valid_to > valid_from"),
    "windows_never_run_backwards": ("dim_order_status_history", "valid_to >= valid_from"),
    "duration_is_not_negative": ("dim_order_status_history", "seconds_in_status >= 0 OR seconds_in_status IS NULL"),
}
RELATIONSHIPS = """fct_orders customer_unique_id dim_customer customer_unique_id
fct_order_items order_id fct_orders order_id
fct_order_items product_key dim_product product_key
fct_order_items seller_key dim_seller seller_key"""

# The tables with faults planted, from the sound ones (`_ok`).
FAULTY = {
    "cdc_events": """SELECT * REPLACE (
            CASE WHEN source_table = 'seller' AND kafka_offset % 3 = 1 THEN 'merge' ELSE op END AS op,
            CASE WHEN source_table <> 'seller' OR kafka_offset % 5 <> 2 THEN pk END AS pk)
        FROM (FROM cdc_events_ok UNION ALL FROM cdc_events_ok WHERE source_table = 'product' AND kafka_offset % 101 = 7)""",
    "dim_customer": """SELECT * REPLACE (is_current OR CAST(customer_unique_id AS INTEGER) % 29 = 4 AS is_current) FROM (
        FROM dim_customer_ok WHERE NOT (version = 2 AND CAST(customer_unique_id AS INTEGER) % 3 = 0)
        UNION ALL FROM dim_customer_ok WHERE version = 1 AND CAST(customer_unique_id AS INTEGER) % 41 = 5)""",
    "dim_order_status_history": """SELECT * REPLACE (
            CASE WHEN NOT is_current AND CAST(order_id AS INTEGER) % 50 = 11 THEN valid_from - 1000 ELSE valid_to END AS valid_to,
            CASE WHEN version = 1 AND CAST(order_id AS INTEGER) % 70 = 9 THEN 'lost'
                 WHEN version <> 1 OR CAST(order_id AS INTEGER) % 90 <> 1 THEN order_status END AS order_status)
        FROM dim_order_status_history_ok""",
    "dim_product": """SELECT * REPLACE (
            CASE WHEN CAST(product_id AS INTEGER) % 37 <> 3 THEN category_name END AS category_name)
        FROM dim_product_ok WHERE CAST(product_id AS INTEGER) % 53 <> 0""",
    "fct_orders": "FROM fct_orders_ok WHERE CAST(order_id AS INTEGER) % 45 <> 0",
    "fct_order_items": """SELECT * REPLACE (CASE WHEN CAST(order_id AS INTEGER) % 33 = 2 THEN -price ELSE price END AS price)
        FROM fct_order_items_ok WHERE CAST(order_id AS INTEGER) % 20 <> 0 OR order_item_id <> 1""",
}


def _faulty_tables() -> str:
    tables = GATE_TABLES.strip()
    for name in FAULTY:
        tables = re.sub(rf"(?m)^{name} AS", f"{name}_ok AS", tables)
    return tables + "".join(f",\n{name} AS ({sql})" for name, sql in FAULTY.items())


def _gate() -> str:
    """Offences of every declared check, counted one check at a time."""
    checks = {}
    for line in NOT_NULL.split("\n"):
        t, *columns = line.split()
        checks |= {f"{t}.not_null_{c}": f"SELECT 1 FROM {t} WHERE {c} IS NULL" for c in columns}
    for line in UNIQUE.split("\n"):
        t, *columns = line.split()
        for c in columns:
            checks[f"{t}.unique_{c}"] = (
                f"SELECT 1 FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
            )
    for line in COMBINATIONS.split("\n"):
        t, *columns = line.split()
        checks[f"{t}.unique_{'_'.join(columns)}"] = (
            f"SELECT 1 FROM {t} GROUP BY {', '.join(columns)} HAVING count(*) > 1"
        )
    for line in VALUES.split("\n"):
        t, c, *values = line.split()
        listed = ", ".join(f"'{v}'" for v in values)
        checks[f"{t}.accepted_values_{c}"] = f"SELECT 1 FROM {t} WHERE {c} NOT IN ({listed})"
    for name, (t, expression) in EXPRESSIONS.items():
        checks[f"{t}.{name}"] = f"SELECT 1 FROM {t} WHERE NOT ({expression})"
    for line in RELATIONSHIPS.split("\n"):
        t, c, parent, p = line.split()
        checks[f"{t}.relationship_{c}"] = (
            f"SELECT {c} FROM {t} WHERE {c} NOT IN (SELECT {p} FROM {parent} WHERE {p} IS NOT NULL) GROUP BY 1"
        )
    checks["fct_order_items.price_is_positive"] = "SELECT 1 FROM fct_order_items WHERE price <= 0"
    checks |= SPANNING_CHECKS
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"check\", (SELECT count(*) FROM ({sql})) AS violations"
        for name, sql in checks.items()
    )


def oracle_sql() -> dict[str, str]:
    common = CTES.strip()
    sql = {name: f"WITH {common}\n{select.strip()}" for name, select in SELECTS.items()}
    sql["gate_counts"] = f"WITH {common},\n{GATE_TABLES.strip()}\n{_gate()}"
    sql["gate_counts_of_faults"] = f"WITH {common},\n{_faulty_tables()}\n{_gate()}"
    return sql
