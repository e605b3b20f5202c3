"""The datasets of the checks, derived from the given tables by SQL.

Each view is one SELECT that Spark and DuckDB both accept, so the checks and
their SQL counterparts read the same rows. Defects are seeded by key arithmetic
and spread over the whole table.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from plumbline.session import work_dir

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

_CENTS = "CAST(CAST({0} AS DECIMAL(14,2)) * 0.01 AS DECIMAL(14,2))"
_HOUR = "CAST(date_trunc('hour', ts) AS TIMESTAMP)"

VIEWS: dict[str, str] = {
    # Orders
    "source_orders": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS ordered_at,
               CAST(o_totalprice AS DECIMAL(14,2)) AS gross_amount,
               {_CENTS.format('o_orderkey * 37 % 1500')} AS discount_amount,
               CASE WHEN o_orderkey % 17 = 0
                    THEN CAST(ROUND(CAST(o_totalprice AS DECIMAL(14,2)) * 0.10, 2) AS DECIMAL(14,2))
                    ELSE CAST(0 AS DECIMAL(14,2)) END AS refund_amount,
               o_orderdate + (o_orderkey % 48) * INTERVAL '1' HOUR AS updated_at
        FROM orders""",
    "clean_orders": """
        SELECT order_id, customer_id, ordered_at,
               CAST(gross_amount - discount_amount - refund_amount AS DECIMAL(14,2)) AS net_amount
        FROM source_orders""",
    "target_orders": """
        SELECT order_id, CASE WHEN order_id % 113 = 0 THEN -1 ELSE customer_id END AS customer_id, ordered_at,
               CASE WHEN order_id % 107 = 0 THEN NULL
                    WHEN order_id % 103 = 0 THEN CAST(net_amount + 0.01 AS DECIMAL(14,2)) ELSE net_amount END AS net_amount
        FROM clean_orders WHERE order_id % 101 <> 0
        UNION ALL SELECT order_id, customer_id, ordered_at, net_amount FROM clean_orders WHERE order_id % 109 = 0
        UNION ALL SELECT order_id + 100000000000, customer_id, ordered_at, net_amount FROM clean_orders WHERE order_id % 127 = 0""",
    "gold_daily_sales": """
        SELECT CAST(ordered_at AS DATE) AS order_date, COUNT(*) AS order_count,
               CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue
        FROM clean_orders GROUP BY CAST(ordered_at AS DATE)""",
    "target_daily_sales": """
        SELECT order_date, CASE WHEN EXTRACT(DAY FROM order_date) = 11 THEN order_count + 1 ELSE order_count END AS order_count,
               CASE WHEN EXTRACT(DAY FROM order_date) = 7 THEN CAST(net_revenue + 0.01 AS DECIMAL(18,2))
                    ELSE net_revenue END AS net_revenue
        FROM gold_daily_sales WHERE EXTRACT(DAY FROM order_date) <> 13""",
    "order_lines": """
        SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_id,
               CAST(l_extendedprice AS DECIMAL(14,2)) AS net_amount FROM lineitem""",
    "order_payments": """
        SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS payment_id,
               CAST(l_extendedprice AS DECIMAL(14,2)) AS paid_amount FROM lineitem""",
    "line_totals": """
        SELECT order_id, CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_amount FROM order_lines GROUP BY order_id""",
    "target_order_totals": """
        SELECT order_id, CASE WHEN order_id % 61 = 0 THEN NULL
                              WHEN order_id % 59 = 0 THEN CAST(net_amount * 2 AS DECIMAL(18,2)) ELSE net_amount END AS net_amount
        FROM line_totals WHERE order_id % 53 <> 0
        UNION ALL SELECT order_id + 100000000000, net_amount FROM line_totals WHERE order_id % 67 = 0""",
    # Versions
    "source_order_events": f"""
        SELECT event_id, user_id AS order_id, {_HOUR} AS updated_at, CAST(value AS DECIMAL(14,2)) AS net_amount FROM events""",
    "ranked_order_events": """
        SELECT event_id, order_id, updated_at, net_amount,
               ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY updated_at DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn
        FROM source_order_events""",
    "target_current_orders": """
        SELECT event_id, order_id, updated_at, CASE WHEN order_id % 31 = 0 THEN NULL ELSE net_amount END AS net_amount
        FROM ranked_order_events
        WHERE (rn = 1 AND order_id % 23 <> 0 AND order_id % 29 <> 0) OR (rn = 2 AND order_id % 29 = 0)""",
    "source_time_orders": """
        SELECT event_id AS order_id, ts AS ordered_at, CAST(value AS DECIMAL(14,2)) AS net_amount FROM events""",
    "clean_utc_daily": """
        SELECT CAST(ordered_at AS DATE) AS order_date, COUNT(*) AS order_count, CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue
        FROM source_time_orders GROUP BY CAST(ordered_at AS DATE)""",
    "target_utc_daily": """
        SELECT order_date, order_count, CASE WHEN EXTRACT(DAY FROM order_date) % 7 = 0 THEN NULL ELSE net_revenue END AS net_revenue
        FROM clean_utc_daily WHERE EXTRACT(DAY FROM order_date) % 5 <> 0""",
    "incremental_events": f"""
        SELECT event_id, user_id AS order_id, {_HOUR} AS event_at, ts + (event_id % 72) * INTERVAL '1' HOUR AS arrived_at,
               CAST(value AS DECIMAL(14,2)) AS net_amount, CAST(event_id % 3 + 1 AS INT) AS batch_no FROM events""",
    "lab_context": "SELECT 'C10' AS lab_id, MIN(ts) + INTERVAL '20' DAY AS as_of FROM events",
    "incremental_ranked": """
        SELECT e.event_id, e.order_id, e.event_at, e.net_amount,
               ROW_NUMBER() OVER (PARTITION BY e.order_id ORDER BY e.event_at DESC NULLS FIRST, e.event_id DESC NULLS FIRST) AS rn
        FROM incremental_events e WHERE e.arrived_at <= (SELECT as_of FROM lab_context)""",
    "incremental_target": """
        SELECT event_id, order_id, event_at, net_amount FROM incremental_ranked
        WHERE (rn = 1 AND order_id % 19 <> 0) OR (rn = 2 AND order_id % 19 = 0)
        UNION ALL SELECT event_id, order_id, event_at, net_amount FROM incremental_ranked WHERE rn = 1 AND order_id % 37 = 0""",
    "freshness_requirements": """
        SELECT event_type || '-' || CAST(user_id AS STRING) AS dataset_id, (SELECT MAX(ts) FROM events) AS as_of,
               CAST(1440 * (1 + user_id % 4) AS INT) AS sla_minutes
        FROM events GROUP BY event_type, user_id""",
    "freshness_observations": """
        SELECT event_type || '-' || CAST(user_id AS STRING) AS dataset_id, MAX(ts) AS last_success_at,
               CASE WHEN user_id % 13 = 0 THEN NULL WHEN user_id % 11 = 0 THEN MAX(ts) + INTERVAL '40' DAY
                    ELSE MAX(ts) - (user_id % 7) * INTERVAL '1' MINUTE END AS last_event_at,
               CASE WHEN user_id % 17 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS execution_status
        FROM events WHERE user_id % 23 <> 0 GROUP BY event_type, user_id""",
    "source_customer_changes": f"""
        SELECT event_id, user_id AS customer_id, {_HOUR} AS effective_at, event_type AS tier FROM events""",
    "ranked_changes": """
        SELECT event_id, customer_id, effective_at, tier,
               ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY effective_at DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn
        FROM source_customer_changes""",
    "target_customers_current": """
        SELECT event_id, customer_id, effective_at, CASE WHEN customer_id % 31 = 0 THEN NULL ELSE tier END AS tier
        FROM ranked_changes
        WHERE (rn = 1 AND customer_id % 23 <> 0 AND customer_id % 29 <> 0) OR (rn = 2 AND customer_id % 29 = 0)""",
    "instant_changes": """
        SELECT event_id, customer_id, effective_at, tier,
               ROW_NUMBER() OVER (PARTITION BY customer_id, effective_at ORDER BY event_id DESC NULLS FIRST) AS rn
        FROM source_customer_changes""",
    "clean_history": """
        SELECT event_id AS version_id, customer_id, tier, effective_at AS valid_from,
               LEAD(effective_at) OVER (PARTITION BY customer_id ORDER BY effective_at ASC NULLS LAST) AS valid_to
        FROM instant_changes WHERE rn = 1""",
    "target_customer_history": """
        SELECT version_id, customer_id, CASE WHEN version_id % 61 = 0 THEN 'SILVER' ELSE tier END AS tier, valid_from,
               CASE WHEN version_id % 97 = 0 THEN valid_to + INTERVAL '3' DAY
                    WHEN version_id % 73 = 0 THEN valid_from
                    WHEN version_id % 1009 = 0 THEN valid_from - INTERVAL '30' HOUR ELSE valid_to END AS valid_to,
               CASE WHEN version_id % 89 = 0 THEN valid_to IS NOT NULL ELSE valid_to IS NULL END AS is_current
        FROM clean_history WHERE version_id % 83 <> 0
        UNION ALL SELECT version_id + 100000000000, customer_id, tier, valid_from, valid_to, valid_to IS NULL
        FROM clean_history WHERE version_id % 79 = 0
        UNION ALL SELECT version_id, customer_id, tier, valid_from, valid_to, valid_to IS NULL
        FROM clean_history WHERE version_id % 101 = 0""",
    # Text amounts
    "etl_customers": "SELECT 'C-' || CAST(c_custkey AS STRING) AS customer_code, c_custkey AS customer_id FROM customer",
    "etl_source": """
        SELECT order_id, 'C-' || CAST(customer_id AS STRING) AS customer_code,
               CASE WHEN order_id % 97 = 0 THEN 'oops' WHEN order_id % 89 = 0 THEN '1,23'
                    ELSE CAST(gross_amount AS STRING) END AS gross_text,
               CAST(discount_amount AS STRING) AS discount_text,
               CAST(order_id % 3 + 1 AS INT) AS arrived_batch, order_id AS event_id
        FROM source_orders""",
    "etl_clean_source": "SELECT * FROM etl_source WHERE order_id % 97 <> 0 AND order_id % 89 <> 0",
    "etl_good_target": """
        SELECT order_id, customer_id, CAST(gross_amount - discount_amount AS DECIMAL(18,2)) AS net_amount, order_id AS event_id
        FROM source_orders WHERE order_id % 97 <> 0 AND order_id % 89 <> 0""",
    "etl_target": """
        SELECT order_id, CASE WHEN order_id % 31 = 0 THEN customer_id + 1 ELSE customer_id END AS customer_id,
               CASE WHEN order_id % 37 = 0 THEN NULL WHEN order_id % 41 = 0 THEN CAST(ROUND(net_amount, 0) AS DECIMAL(18,2))
                    ELSE net_amount END AS net_amount, event_id
        FROM etl_good_target WHERE order_id % 43 <> 0
        UNION ALL SELECT order_id, customer_id, CAST(0 AS DECIMAL(18,2)), order_id FROM source_orders WHERE order_id % 970 = 0""",
    "etl_rejects": """
        SELECT order_id, CASE WHEN order_id % 7 = 0 THEN 'OTHER' ELSE 'INVALID_AMOUNT' END AS reason
        FROM etl_source WHERE (order_id % 97 = 0 OR order_id % 89 = 0) AND order_id % 5 <> 0
        UNION ALL SELECT order_id, 'INVALID_AMOUNT' FROM etl_source WHERE order_id % 97 = 0 AND order_id % 11 = 0""",
    "etl_context": "SELECT 'C17' AS lab_id, MAX(ts) AS as_of, CAST(2 AS INT) AS batch_no FROM events",
    "replay_source": """
        SELECT user_id AS order_id, 'C-' || CAST(user_id AS STRING) AS customer_code,
               CAST(CAST(value AS DECIMAL(14,2)) AS STRING) AS gross_text, '0.01' AS discount_text,
               CAST(event_id % 3 + 1 AS INT) AS arrived_batch, event_id
        FROM events""",
    "replay_ranked": """
        SELECT order_id, event_id, gross_text, discount_text,
               ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY event_id DESC NULLS FIRST) AS rn
        FROM replay_source WHERE arrived_batch <= (SELECT batch_no FROM etl_context)""",
    "replay_target": """
        SELECT order_id, order_id AS customer_id,
               CAST(CAST(gross_text AS DECIMAL(18,2)) - CAST(discount_text AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS net_amount, event_id
        FROM replay_ranked WHERE (rn = 1 AND order_id % 19 <> 0) OR (rn = 2 AND order_id % 19 = 0) OR (rn = 1 AND order_id % 23 = 0)""",
    "etl_steps": """
        SELECT CAST(arrived_batch AS INT) AS step_no, 'RUN' AS operation,
               CASE WHEN arrived_batch = 3 THEN 'FAILED' ELSE 'SUCCESS' END AS execution_status,
               COUNT(*) AS target_rows, CAST(0 AS BIGINT) AS rejected_rows, CAST(arrived_batch AS INT) AS checkpoint
        FROM etl_source GROUP BY arrived_batch""",
    # API records: five orders per page, five hundred per crawl
    "api_expected": """
        SELECT CAST(FLOOR(order_id * 0.002) AS BIGINT) AS crawl_id, order_id, customer_id,
               CAST(net_amount AS DECIMAL(18,2)) AS net_amount
        FROM clean_orders""",
    "api_listing": """
        SELECT crawl_id, order_id, customer_id, net_amount,
               CAST(FLOOR((order_id - crawl_id * 500) * 0.2) AS BIGINT) + 1 AS page, order_id % 5 AS pos,
               order_id % 211 = 0 AS lost, order_id % 223 = 0 AS doubled, order_id % 227 = 0 AS text_customer,
               order_id % 229 = 0 AS no_amount, order_id % 233 = 0 AS wrong_amount, order_id % 239 = 0 AS text_key
        FROM api_expected""",
    "api_last_page": """
        SELECT crawl_id, MAX(page) AS last_page,
               CASE WHEN crawl_id % 4 = 1 THEN LEAST(60, MAX(page)) ELSE MAX(page) + 1 END AS failed_page
        FROM api_listing GROUP BY crawl_id""",
    "api_served": """
        SELECT l.* FROM api_listing l JOIN api_last_page p ON l.crawl_id = p.crawl_id
        WHERE NOT l.lost AND l.page < p.failed_page""",
    "api_delivered": """
        SELECT crawl_id, page, pos, order_id, customer_id, text_customer, no_amount, text_key,
               CASE WHEN wrong_amount THEN CAST(net_amount + 0.01 AS DECIMAL(18,2)) ELSE net_amount END AS net_amount FROM api_served
        UNION ALL
        SELECT crawl_id, page, pos + 10, order_id, customer_id, text_customer, no_amount, text_key, net_amount
        FROM api_served WHERE doubled""",
    "api_record_keys": """
        SELECT crawl_id, CASE WHEN text_key THEN '"' || CAST(order_id AS STRING) || '"' ELSE CAST(order_id AS STRING) END AS record_key
        FROM api_delivered""",
    "api_loaded": """
        SELECT crawl_id, page, pos, order_id, customer_id, net_amount FROM api_delivered
        WHERE NOT text_customer AND NOT no_amount AND NOT text_key""",
    # Evidence
    "cloud_context": """
        SELECT 'C25' AS lab_id, CAST(2 AS INT) AS batch_no, MIN(ts) + INTERVAL '25' DAY AS as_of, 'ADF' AS provider,
               'workspace' AS resource_id, 'IMPORTED' AS provenance, MAX(ts) AS captured_at, CAST(1 AS INT) AS mapping_version
        FROM events""",
    "cloud_source": """
        SELECT user_id AS order_id, user_id % 10 AS customer_id, CAST(value AS DECIMAL(14,2)) AS amount, ts AS updated_at, event_id,
               CAST(event_id % 3 + 1 AS INT) AS batch_no, 'run-' || CAST(event_id % 97 AS STRING) AS run_id
        FROM events""",
    "cloud_ranked": """
        SELECT order_id, customer_id, amount, updated_at, event_id, batch_no, run_id,
               ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY event_id DESC NULLS FIRST) AS rn
        FROM cloud_source
        WHERE batch_no <= (SELECT batch_no FROM cloud_context) AND updated_at <= (SELECT as_of FROM cloud_context)""",
    "cloud_latest": "SELECT order_id, customer_id, amount, updated_at, event_id, batch_no, run_id FROM cloud_ranked WHERE rn = 1",
    "cloud_bronze": """
        SELECT order_id, customer_id, amount, updated_at, event_id, batch_no, run_id FROM cloud_ranked
        WHERE (rn = 1 AND order_id % 53 <> 0) OR (rn = 2 AND order_id % 59 = 0)""",
    "cloud_silver": """
        SELECT CASE WHEN order_id % 41 = 0 THEN order_id + 100000000000 ELSE order_id END AS order_id, customer_id, amount,
               updated_at, event_id, batch_no, run_id FROM cloud_bronze""",
    "cloud_target": """
        SELECT order_id, customer_id, CASE WHEN order_id % 43 = 0 THEN CAST(amount + 0.01 AS DECIMAL(14,2)) ELSE amount END AS amount,
               updated_at, event_id, batch_no, run_id FROM cloud_silver
        UNION ALL SELECT * FROM cloud_silver WHERE order_id % 47 = 0""",
    "cloud_runs": """
        SELECT DISTINCT 'run-' || CAST(c_custkey % 97 AS STRING) AS run_id,
               CASE WHEN c_custkey % 97 = 5 THEN 'UNKNOWN' WHEN c_custkey % 97 = 6 THEN 'FAILED' ELSE 'SUCCESS' END AS execution_status,
               (SELECT as_of FROM cloud_context) - (c_custkey % 97) * INTERVAL '1' MINUTE AS started_at,
               CASE WHEN c_custkey % 97 = 8 THEN NULL ELSE (SELECT as_of FROM cloud_context) END AS ended_at
        FROM customer WHERE c_custkey % 97 <> 7""",
    "cloud_activities": """
        SELECT 'act-' || CAST(c_custkey AS STRING) AS activity_id, 'run-' || CAST(c_custkey % 97 AS STRING) AS run_id,
               CASE WHEN c_custkey < 97 THEN NULL WHEN c_custkey % 31 = 0 THEN 'act-missing'
                    ELSE 'act-' || CAST(c_custkey - 97 AS STRING) END AS dependency_id,
               CASE WHEN c_custkey % 41 = 0 THEN 'UNKNOWN' WHEN c_custkey % 43 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS execution_status,
               CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE 'source' END AS source_dataset,
               CASE WHEN c_custkey % 2 = 0 THEN 'target' ELSE 'bronze' END AS target_dataset,
               CASE WHEN c_custkey % 6 = 0 THEN (SELECT COUNT(*) FROM cloud_latest) WHEN c_custkey % 10 = 0 THEN NULL
                    ELSE c_custkey END AS rows_read,
               CASE WHEN c_custkey % 4 = 0 THEN (SELECT COUNT(*) FROM cloud_target) ELSE c_custkey END AS rows_written
        FROM customer""",
    "timed_activities": """
        SELECT a.activity_id, CASE WHEN a.rows_read % 17 = 0 THEN -a.rows_read - 1 ELSE a.rows_read END AS rows_read,
               CASE WHEN a.rows_written % 13 = 0 THEN NULL WHEN a.rows_written % 11 = 0 THEN r.ended_at + INTERVAL '1' MINUTE
                    ELSE r.started_at END AS started_at, r.ended_at
        FROM cloud_activities a JOIN cloud_runs r ON a.run_id = r.run_id""",
    "cloud_steps": """
        SELECT CAST(r_regionkey + 1 AS INT) AS step_no, 'RECOVER' AS operation,
               'run-' || CAST(r_regionkey AS STRING) AS run_id, 'SUCCESS' AS execution_status, CAST(r_regionkey AS INT) AS batch_no,
               CAST(r_regionkey AS BIGINT) AS target_rows, (SELECT as_of FROM cloud_context) AS watermark
        FROM region""",
    "cloud_expected_schema": """
        SELECT 'part-' || CAST(p_partkey % 97 AS STRING) AS dataset, 'c' || CAST(p_partkey AS STRING) AS column_name, p_type AS data_type
        FROM part""",
    "cloud_schema": """
        SELECT dataset, CASE WHEN p_partkey % 19 = 0 THEN column_name || '_x' ELSE column_name END AS column_name,
               CASE WHEN p_partkey % 23 = 0 THEN 'float' ELSE data_type END AS data_type
        FROM (SELECT p_partkey, 'part-' || CAST(p_partkey % 97 AS STRING) AS dataset,
                     'c' || CAST(p_partkey AS STRING) AS column_name, p_type AS data_type FROM part) reported
        UNION ALL SELECT 'part-' || CAST(p_partkey % 97 AS STRING), 'c' || CAST(p_partkey AS STRING), p_type
        FROM part WHERE p_partkey % 29 = 0""",
    "cloud_expected_partitions": """
        SELECT CAST(order_date AS STRING) AS partition_key, CASE WHEN EXTRACT(DAY FROM order_date) = 3 THEN order_count + 1
               ELSE order_count END AS row_count
        FROM gold_daily_sales WHERE EXTRACT(DAY FROM order_date) <> 17""",
    "cloud_files": """
        SELECT CAST(CAST(o_orderdate AS DATE) AS STRING) AS partition_key, o_orderkey % 4 AS part_no, COUNT(*) AS row_count,
               MAX(o_orderdate) AS snapshot_at
        FROM orders GROUP BY CAST(o_orderdate AS DATE), o_orderkey % 4""",
    "cloud_manifest": """
        SELECT partition_key, partition_key || '/' || CAST(part_no AS STRING) AS file_key,
               CASE WHEN row_count = 7 THEN NULL ELSE row_count END AS row_count, snapshot_at, 'run-1' AS run_id
        FROM cloud_files WHERE partition_key NOT LIKE '%-19'
        UNION ALL SELECT partition_key, partition_key || '/' || CAST(part_no AS STRING), row_count, snapshot_at, 'run-1'
        FROM cloud_files WHERE partition_key LIKE '%-23' AND part_no = 1""",
    "cloud_required_references": """
        SELECT event_type AS dataset_id, 'ref-' || CAST(user_id AS STRING) AS reference_id,
               CAST(1440 * (3 + user_id % 25) AS INT) AS sla_minutes
        FROM events WHERE user_id % 13 <> 0 GROUP BY event_type, user_id""",
    "cloud_references": """
        SELECT event_type AS dataset_id, 'ref-' || CAST(user_id AS STRING) AS reference_id,
               CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN ts + INTERVAL '40' DAY ELSE ts END AS observed_at,
               'run-1' AS run_id
        FROM events WHERE user_id % 17 <> 0""",
    "reference_context": "SELECT MAX(ts) AS as_of FROM events",
    # Suites of rules, one per part size
    "declared_rules": """
        SELECT CASE WHEN p_size = 7 THEN 'Suite 7' ELSE 'suite_' || CAST(p_size AS STRING) END AS suite_id, p_partkey AS place,
               CASE WHEN p_partkey % 41 = 0 THEN ' ' WHEN p_partkey % 9 = 0 THEN 'rule_again' ELSE 'rule_' || CAST(p_partkey AS STRING) END AS rule_id,
               CASE WHEN p_partkey % 4 = 0 THEN 'RECORD_COUNT' WHEN p_partkey % 4 = 1 THEN 'NOT_NULL' WHEN p_partkey % 4 = 2 THEN 'KEY_RECONCILIATION'
                    ELSE 'FIELD_RECONCILIATION' END AS kind,
               CAST(CASE WHEN p_partkey % 29 = 0 THEN 0 WHEN p_partkey % 31 = 0 THEN 101 ELSE 20 END AS INT) AS evidence FROM part""",
    "declared_datasets": """
        SELECT suite_id, place, 'part_' || CAST(place % 10 AS STRING) AS dataset_id FROM declared_rules
        UNION ALL SELECT suite_id, place, 'part_' || CAST((place + 1) % 10 AS STRING) FROM declared_rules
        WHERE (place % 4 >= 2 AND place % 53 <> 0) OR place % 59 = 0""",
    "declared_columns": """
        SELECT suite_id, place, CASE WHEN place % 19 = 0 THEN 'No Name' ELSE 'c' || CAST(place % 7 AS STRING) END AS column_name
        FROM declared_rules WHERE place % 43 <> 0
        UNION ALL SELECT suite_id, place, 'c' || CAST(place % 6 AS STRING) FROM declared_rules WHERE place % 23 = 0""",
    "declared_catalog": """
        SELECT DISTINCT 'part_' || CAST(p_partkey % 9 AS STRING) AS dataset_id, 'orders' AS table_name FROM part
        UNION ALL SELECT DISTINCT 'part_3', 'customers' FROM part UNION ALL SELECT DISTINCT 'Part 9', 'customers' FROM part""",
    # Evidence without a flaw
    "sound_runs": """
        SELECT DISTINCT run_id, 'SUCCESS' AS execution_status, (SELECT as_of FROM cloud_context) - INTERVAL '1' HOUR AS started_at,
               (SELECT as_of FROM cloud_context) AS ended_at, 'none' AS raw_evidence FROM cloud_source""",
    "sound_activities": """
        SELECT 'pull-' || run_id AS activity_id, run_id, CAST(NULL AS STRING) AS dependency_id, 'SUCCESS' AS execution_status,
               'source' AS source_dataset, 'bronze' AS target_dataset, (SELECT COUNT(*) FROM cloud_latest) AS rows_read,
               (SELECT COUNT(*) FROM cloud_latest) AS rows_written, 'none' AS raw_evidence FROM (SELECT DISTINCT run_id FROM cloud_source) p
        UNION ALL SELECT 'send-' || run_id, run_id, 'pull-' || run_id, 'SUCCESS', 'silver', 'target', (SELECT COUNT(*) FROM cloud_latest),
               (SELECT COUNT(*) FROM cloud_latest), 'none' FROM (SELECT DISTINCT run_id FROM cloud_source) s""",
    "sound_schema": """
        SELECT DISTINCT p_brand AS dataset, 'amount' AS column_name, 'numeric(14,2)' AS data_type FROM part
        UNION ALL SELECT DISTINCT p_brand, 'order_id', 'bigint' FROM part
        UNION ALL SELECT DISTINCT p_brand, p_type, 'text' FROM part""",
    "sound_manifest": """
        SELECT partition_key, partition_key || '/' || CAST(part_no AS STRING) AS file_key, row_count, snapshot_at, 'run-1' AS run_id
        FROM cloud_files""",
    "sound_partitions": "SELECT partition_key, CAST(SUM(row_count) AS BIGINT) AS row_count FROM cloud_files GROUP BY partition_key",
    "sound_required_references": """
        SELECT event_type AS dataset_id, 'ref-' || CAST(user_id AS STRING) AS reference_id, CAST(10 + user_id % 50 AS INT) AS sla_minutes
        FROM events GROUP BY event_type, user_id""",
    "sound_references": """
        SELECT dataset_id, reference_id, (SELECT as_of FROM cloud_context) - sla_minutes * INTERVAL '1' MINUTE AS observed_at, 'run-1' AS run_id
        FROM sound_required_references""",
    "sound_steps": """
        SELECT CAST(1 AS INT) AS step_no, 'INITIAL' AS operation, 'run-1' AS run_id, 'SUCCESS' AS execution_status, batch_no,
               (SELECT COUNT(*) FROM cloud_latest) AS target_rows, as_of AS watermark FROM cloud_context""",
    # Contracts
    "db_source": """
        SELECT c_custkey AS record_id, CASE WHEN c_custkey % 13 = 0 THEN 0 ELSE c_custkey + 1 END AS customer_id,
               CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_acctbal AS DECIMAL(14,2)) END AS amount, 'run-1' AS run_id
        FROM customer""",
    "db_contract": """
        SELECT record_id, CASE WHEN customer_id <= 0 THEN 'REJECTED' WHEN amount IS NULL THEN 'QUARANTINED' ELSE 'ACCEPTED' END AS classification,
               amount FROM db_source""",
    "db_publication": """
        SELECT record_id, CASE WHEN record_id % 31 = 0 THEN 'QUARANTINED' ELSE classification END AS classification, amount, 'run-1' AS run_id
        FROM db_contract WHERE record_id % 37 <> 0
        UNION ALL SELECT record_id, classification, amount, 'run-1' FROM db_contract WHERE record_id % 41 = 0""",
    "db_before": """
        SELECT order_id, order_id % 5 AS version, gross_amount AS amount, updated_at, 'run-1' AS run_id FROM source_orders""",
    "db_incoming": """
        SELECT CASE WHEN order_id % 50 = 0 THEN order_id + 100000000000 ELSE order_id END AS order_id, order_id % 7 AS version,
               CAST(gross_amount + 1 AS DECIMAL(14,2)) AS amount, updated_at + INTERVAL '1' HOUR AS updated_at, 'run-2' AS run_id
        FROM source_orders WHERE order_id % 3 = 0 OR order_id % 50 = 0""",
    "db_expected_after": """
        SELECT b.order_id, CASE WHEN i.version > b.version THEN i.version ELSE b.version END AS version,
               CASE WHEN i.version > b.version THEN i.amount ELSE b.amount END AS amount,
               CASE WHEN i.version > b.version THEN i.updated_at ELSE b.updated_at END AS updated_at
        FROM db_before b LEFT JOIN db_incoming i ON b.order_id = i.order_id
        UNION ALL SELECT i.order_id, i.version, i.amount, i.updated_at FROM db_incoming i
        WHERE NOT EXISTS (SELECT 1 FROM db_before b WHERE b.order_id = i.order_id)""",
    "db_after": """
        SELECT order_id, CASE WHEN order_id % 61 = 0 THEN CAST(0 AS BIGINT) ELSE version END AS version,
               CASE WHEN order_id % 67 = 0 THEN CAST(amount + 0.01 AS DECIMAL(14,2)) ELSE amount END AS amount, updated_at, 'run-2' AS run_id
        FROM db_expected_after WHERE order_id % 71 <> 0
        UNION ALL SELECT order_id, version, amount, updated_at, 'run-2' FROM db_expected_after WHERE order_id % 73 = 0""",
    "sy_staging": """
        SELECT order_id AS sale_id, 'C-' || CAST(customer_id AS STRING) AS customer_code, net_amount AS amount,
               CAST(ordered_at AS DATE) AS sale_date, 'run-1' AS run_id FROM clean_orders""",
    "sy_dimension": """
        SELECT 'C-' || CAST(c_custkey AS STRING) AS customer_code, c_custkey AS customer_key, n_name AS region, 'run-1' AS run_id
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "sy_fanout_dimension": """
        SELECT * FROM sy_dimension UNION ALL SELECT * FROM sy_dimension WHERE region = 'NATION_5'""",
    "sy_expected_fact": """
        SELECT s.sale_id, d.customer_key, s.amount, s.sale_date FROM sy_staging s JOIN sy_dimension d ON s.customer_code = d.customer_code""",
    "sy_fact": """
        SELECT CASE WHEN sale_id % 61 = 0 THEN sale_id + 100000000000 ELSE sale_id END AS sale_id,
               CASE WHEN sale_id % 67 = 0 THEN CAST(-9999 AS BIGINT) ELSE customer_key END AS customer_key, amount, sale_date, 'run-1' AS run_id
        FROM sy_expected_fact WHERE sale_id % 71 <> 0
        UNION ALL SELECT sale_id, customer_key, amount, sale_date, 'run-1' FROM sy_expected_fact WHERE sale_id % 73 = 0""",
    "sy_expected_report": """
        SELECT f.sale_date, d.region, COUNT(*) AS sale_count, CAST(SUM(f.amount) AS DECIMAL(14,2)) AS total
        FROM sy_expected_fact f JOIN sy_dimension d ON f.customer_key = d.customer_key GROUP BY f.sale_date, d.region""",
    "sy_report": """
        SELECT f.sale_date, CASE WHEN d.region = 'NATION_7' THEN 'NATION_7-wrong' ELSE d.region END AS region, COUNT(*) AS sale_count,
               CAST(SUM(f.amount) AS DECIMAL(14,2)) AS total, 'run-1' AS run_id
        FROM sy_expected_fact f JOIN sy_fanout_dimension d ON f.customer_key = d.customer_key
        GROUP BY f.sale_date, CASE WHEN d.region = 'NATION_7' THEN 'NATION_7-wrong' ELSE d.region END""",
    "az_expected_files": """
        SELECT 'file-' || CAST(p_partkey AS STRING) AS file_id, '/raw/' || p_brand || '/' || CAST(p_partkey AS STRING) AS path,
               p_brand AS route, CAST(p_size AS BIGINT) AS byte_count FROM part""",
    "az_files": """
        SELECT CASE WHEN p_partkey % 19 = 0 THEN 'file-' || CAST(p_partkey AS STRING) || '-unexpected'
                    ELSE 'file-' || CAST(p_partkey AS STRING) END AS file_id,
               CASE WHEN p_partkey % 23 = 0 THEN '/wrong/route.csv' ELSE '/raw/' || p_brand || '/' || CAST(p_partkey AS STRING) END AS path,
               p_brand AS route, CAST(p_size AS BIGINT) AS byte_count,
               CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE (SELECT as_of FROM cloud_context) END AS observed_at, 'run-1' AS run_id
        FROM part
        UNION ALL SELECT 'file-' || CAST(p_partkey AS STRING), '/raw/' || p_brand || '/' || CAST(p_partkey AS STRING), p_brand,
               CAST(p_size AS BIGINT), (SELECT as_of FROM cloud_context), 'run-1' FROM part WHERE p_partkey % 29 = 0""",
    "az_required_access": """
        SELECT 'obs-' || CAST(c_custkey AS STRING) AS observation_id, 'identity-' || CAST(c_custkey AS STRING) AS identity_id,
               '/raw/' || c_mktsegment AS scope, 'READ' AS operation FROM customer""",
    "az_access": """
        SELECT 'obs-' || CAST(c_custkey AS STRING) AS observation_id,
               CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 'identity-' || CAST(c_custkey AS STRING) END AS identity_id,
               '/raw/' || c_mktsegment AS scope, CASE WHEN c_custkey % 17 = 0 THEN 'WRITE' ELSE 'READ' END AS operation,
               CASE WHEN c_custkey % 11 = 0 THEN 'DENIED' ELSE 'ALLOWED' END AS outcome,
               CASE WHEN c_custkey % 19 = 0 THEN NULL
                    WHEN c_custkey % 23 = 0 THEN (SELECT as_of FROM cloud_context) + INTERVAL '1' SECOND
                    ELSE (SELECT as_of FROM cloud_context) END AS observed_at, 'run-1' AS run_id
        FROM customer WHERE c_custkey % 29 <> 0
        UNION ALL SELECT observation_id, identity_id, scope, operation, 'ALLOWED', (SELECT as_of FROM cloud_context), 'run-1'
        FROM az_required_access WHERE identity_id LIKE '%7'""",
}

_NAMES = re.compile(r"\b(" + "|".join(sorted(VIEWS, key=len, reverse=True)) + r")\b")


@lru_cache(maxsize=None)
def needed_views(sql: str) -> tuple[str, ...]:
    """Views a text refers to, those they need first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_NAMES.findall(text)):
            if name not in order:
                visit(VIEWS[name])
                order.append(name)

    visit(sql)
    return tuple(order)


def duckdb_sql(body: str) -> str:
    """A query over views and given tables as one DuckDB statement.

    ``body`` may open with its own ``WITH``; its tables join the list.
    """
    views = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed_views(body))
    text = body.strip()
    if text[:5].upper() == "WITH ":
        return f"WITH {views},\n{text[5:]}" if views else text
    return f"WITH {views}\n{text}" if views else text


def for_spark(sql: str) -> str:
    return sql.replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)")


# Columns of the given tables, so that opening one reads no file.
BASE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
_SOURCE = re.compile(r"\b(FROM|JOIN)\s+(" + "|".join(sorted([*VIEWS, *BASE_TABLES], key=len, reverse=True)) + r")\b")


class Inputs:
    """Views and given tables of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._made: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._base(name) if name in BASE_TABLES else self._view(name)
        return self._made[name]

    def _base(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in BASE_SCHEMAS:
            reader = reader.schema(BASE_SCHEMAS[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    def _view(self, name: str) -> DataFrame:
        text = for_spark(VIEWS[name])
        used = {source: self(source) for _, source in _SOURCE.findall(text)}
        return self.spark.sql(_SOURCE.sub(r"\1 {\2}", text), **used)

    def stored(self, name: str) -> DataFrame:
        """A view written to the shared work folder, for queries that read it several times."""
        key = f"stored:{name}"
        if key not in self._made:
            path = f"{work_dir(self.spark, 'inputs')}/{name}"
            self(name).write.mode("overwrite").parquet(path)
            self._made[key] = self.spark.read.parquet(path)
        return self._made[key]

    def tables(self, *names: str, **renamed: str) -> dict[str, DataFrame]:
        """Views by their own name, or by another one: ``tables(etl_source="replay_source")``."""
        return {**{n: self(n) for n in names}, **{new: self(view) for new, view in renamed.items()}}
