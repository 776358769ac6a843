"""DuckDB statements that state each query's expected answer directly from
the given tables (tables are registered as views by the checker).
Columns are aliased to the names the Spark queries return."""

from __future__ import annotations

from strandline.plans.queries import TABLES

_RESCUED_EVENT = "(event_type = 'error' OR event_id % 37 = 0)"

_METRICS = f"""
    SELECT event_type,
           count(*) AS rows_read,
           count(*) FILTER (WHERE {_RESCUED_EVENT}) AS rows_rescued,
           CAST(count(*) FILTER (WHERE {_RESCUED_EVENT}) AS DOUBLE) / count(*) AS rescued_pct
    FROM events GROUP BY event_type"""

_INVENTORY = " UNION ALL ".join(
    [f"SELECT '{t}' AS source, CAST(1 AS BIGINT) AS files, count(*) AS rows, "
     f"'PRESENT' AS status FROM {t}" for t in TABLES]
    + [f"SELECT '{s}' AS source, CAST(0 AS BIGINT) AS files, CAST(0 AS BIGINT) AS rows, "
       f"'MISSING' AS status" for s in ("transactions", "absent_root")])

ORACLES = {
    "landing_flagship": """
        SELECT event_id, user_id, event_type,
               CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
               CASE WHEN event_type = 'error' THEN '{"value":"n/a"}' END AS _rescued_data
        FROM events""",
    "incremental_ingest": "SELECT event_id, user_id, event_type, value FROM events",
    "replay_idempotent": "SELECT count(*) AS row_count, CAST(1 AS BIGINT) AS batches FROM events",
    "source_lineage": "SELECT 'events.parquet' AS source_file, count(*) AS row_count FROM events",
    "schema_evolution": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority
        FROM orders""",
    "rescue_capture": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 2 = 0 THEN CAST(substr(o_orderpriority, 1, 1) AS BIGINT)
               END AS o_orderpriority,
               CASE WHEN o_orderkey % 2 = 1 THEN '{"o_orderpriority":"' || o_orderpriority || '"}'
               END AS _rescued_data
        FROM orders""",
    "capture_fractional": """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_discount = floor(l_discount) THEN CAST(l_discount AS BIGINT) END AS l_discount,
               (l_discount <> floor(l_discount)) AS is_rescued
        FROM lineitem""",
    "capture_lossy": """
        SELECT l_orderkey, l_linenumber,
               CASE l_linenumber % 3 WHEN 0 THEN false WHEN 1 THEN true END AS flag,
               CASE WHEN l_linenumber % 2 = 0 THEN 9007199254740992 END AS big,
               CASE WHEN l_linenumber % 2 = 0 THEN DATE '2024-01-01' END AS day,
               CASE WHEN l_linenumber % 2 = 0 THEN round(l_quantity) END AS price,
               CASE WHEN l_linenumber % 2 = 0 THEN '1234567890123' || lpad(l_orderkey::VARCHAR, 10, '0') END AS code,
               CASE WHEN l_linenumber % 2 = 0 THEN '0.0000000001' || lpad(l_orderkey::VARCHAR, 10, '0') END AS rate,
               CASE WHEN l_linenumber % 3 = 2 THEN '2024-01-02 10:30:00.123456' END AS at,
               CASE WHEN l_linenumber % 2 = 1 THEN '1234567890123' || lpad(l_orderkey::VARCHAR, 10, '0') || '.5' END AS code_text,
               CASE WHEN l_linenumber % 2 = 1 THEN '0.0000000001' || lpad(l_orderkey::VARCHAR, 10, '0') || '7' END AS rate_text,
               CASE l_linenumber % 3 WHEN 0 THEN '10:30' WHEN 1 THEN '2024-01-02 10:30:00.1234567' END AS at_text,
               l_linenumber % 3 = 2 AS flag_rescued, l_linenumber % 2 = 1 AS big_rescued,
               l_linenumber % 2 = 1 AS day_rescued, l_linenumber % 2 = 1 AS price_rescued
        FROM lineitem""",
    "capture_nested": """
        SELECT o_orderkey,
               '{' || CASE WHEN o_orderkey % 3 <> 0 THEN '"c":' || o_custkey || ',' ELSE '' END
                   || '"tags":[' || o_orderkey || ',null,7]}' AS kept,
               (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END
                + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END)::BIGINT AS misfits,
               CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE o_custkey::VARCHAR END AS c,
               CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END AS tag,
               CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE '1.5' END AS m, false AS is_rescued
        FROM orders""",
    "nested_evolution": """
        SELECT o_orderkey, o_custkey AS c, CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus END AS s,
               CASE WHEN o_orderkey % 3 = 1 THEN 2 ELSE 1 END::BIGINT AS n_parts, o_custkey AS part_c,
               CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus END AS part_s, CAST(NULL AS VARCHAR) AS _rescued_data
        FROM orders""",
    "arrival_order": """
        SELECT arrival, 'o_orderkey:bigint,n:decimal(22,2),d:timestamp_ntz,t:string,s:struct<a:bigint,b:string>' AS columns,
               o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN o_totalprice ELSE o_orderkey END::DOUBLE AS n,
               o_orderdate::DATE AS d,
               CASE o_orderkey % 3 WHEN 0 THEN o_orderstatus WHEN 1 THEN o_custkey::VARCHAR ELSE 'true' END AS t,
               CASE WHEN o_orderkey % 3 <> 1 THEN o_orderkey END AS a,
               CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus END AS b, CAST(NULL AS VARCHAR) AS _rescued_data
        FROM orders, (VALUES ('forward'), ('backward')) v(arrival)
        UNION ALL
        SELECT arrival, 'o_orderkey:bigint,n:bigint', o_orderkey, o_orderkey::DOUBLE, NULL, NULL, NULL, NULL, NULL
        FROM orders, (VALUES ('int_first'), ('long_first')) v(arrival) WHERE o_orderkey % 3 <> 2""",
    "ledger_landing": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN o_totalprice ELSE o_orderkey END::DOUBLE AS n,
               0::BIGINT AS left, true AS bounded
        FROM orders""",
    "evolving_parquet_load": """
        SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority
        FROM orders""",
    "self_repair_partitioned": """
        WITH d AS (SELECT o_orderkey, o_orderkey % 49 = 0 OR o_orderkey % 2 = year(o_orderdate) % 2 AS stays
                   FROM orders WHERE o_orderkey % 7 = 0)
        SELECT count(*) AS rows_rescued_before, count(*) FILTER (WHERE stays) AS rows_rescued_after,
               count(*) FILTER (WHERE NOT stays) AS rows_repaired, 'SUCCESS' AS status,
               (SELECT count(*) FROM orders) AS rows_total, count(*) FILTER (WHERE stays) AS rows_left
        FROM d""",
    "mixed_schema_landing": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 2 = 1 AND o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice
               END AS o_totalprice,
               CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority,
               CASE WHEN o_orderkey % 2 = 1 AND o_orderkey % 5 = 0 THEN '{"o_totalprice":"bad"}'
               END AS _rescued_data
        FROM orders""",
    "rescue_recover": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 49 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice
        FROM orders""",
    "json_field": """
        SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "cast_contract": """
        SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
               l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
        FROM lineitem""",
    "partitioned_append": """
        SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS row_count
        FROM orders GROUP BY CAST(o_orderdate AS DATE)""",
    "rescued_rows": "SELECT o_orderkey FROM orders WHERE o_orderkey % 7 = 0",
    "rescued_count": """
        SELECT count(*) AS rows_total,
               count(*) FILTER (WHERE o_orderkey % 7 = 0) AS rows_rescued,
               CAST(count(*) FILTER (WHERE o_orderkey % 7 = 0) AS DOUBLE) / count(*) AS rescued_pct
        FROM orders""",
    "self_repair_keep": """
        SELECT count(*) FILTER (WHERE o_orderkey % 7 = 0) AS rows_rescued_before,
               count(*) FILTER (WHERE o_orderkey % 49 = 0 OR (o_orderkey % 7 = 0 AND o_orderkey % 70 = 0))
                   AS rows_rescued_after,
               count(*) FILTER (WHERE o_orderkey % 7 = 0)
                 - count(*) FILTER (WHERE o_orderkey % 49 = 0
                                    OR (o_orderkey % 7 = 0 AND o_orderkey % 70 = 0)) AS rows_repaired,
               'SUCCESS' AS status
        FROM orders""",
    "self_repair_clear": """
        SELECT count(*) FILTER (WHERE o_orderkey % 7 = 0) AS rows_rescued_before,
               count(*) FILTER (WHERE o_orderkey % 70 = 0) AS rows_rescued_after,
               count(*) FILTER (WHERE o_orderkey % 7 = 0)
                 - count(*) FILTER (WHERE o_orderkey % 70 = 0) AS rows_repaired,
               'SUCCESS' AS status
        FROM orders""",
    "repair_by_merge": """
        SELECT count(*) FILTER (WHERE o_orderkey % 7 = 0) AS rows_rescued_before,
               count(*) FILTER (WHERE o_orderkey % 70 = 0) AS rows_rescued_after,
               count(*) FILTER (WHERE o_orderkey % 7 = 0)
                 - count(*) FILTER (WHERE o_orderkey % 70 = 0) AS rows_repaired,
               'SUCCESS' AS status
        FROM orders""",
    "self_repair_rows": """
        SELECT CASE WHEN o_orderkey % 70 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey,
               o_custkey,
               CASE WHEN o_orderkey % 49 = 0 OR o_orderkey % 70 = 0 THEN NULL ELSE o_totalprice
               END AS o_totalprice,
               (o_orderkey % 49 = 0 OR o_orderkey % 70 = 0) AS is_rescued
        FROM orders""",
    "update_by_key": """
        SELECT o_orderkey, o_custkey,
               CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice,
               CAST(NULL AS VARCHAR) AS _rescued_data
        FROM orders""",
    "load_metrics": f"""
        SELECT CAST(event_id % 2 AS BIGINT) AS run, CAST(event_id % 2 AS BIGINT) AS batch_id, count(*) AS rows_read,
               count(*) FILTER (WHERE {_RESCUED_EVENT}) AS rows_rescued,
               count(*) FILTER (WHERE {_RESCUED_EVENT}) AS rows_unrecovered,
               CAST(count(*) FILTER (WHERE {_RESCUED_EVENT}) AS DOUBLE) / count(*) AS rescued_pct,
               false AS few_rows_alert
        FROM events GROUP BY event_id % 2
        UNION ALL SELECT 2, NULL, 0, 0, 0, 0.0, true""",
    "run_metrics": _METRICS,
    "threshold_alerts": f"""
        SELECT event_type, 'rescued_pct' AS rule, rescued_pct AS observed, 0.05::DOUBLE AS threshold
        FROM ({_METRICS}) m WHERE rescued_pct > 0.05""",
    "run_log": f"""
        SELECT 'landing_events' AS task_name, event_type AS table_name, 'METRIC' AS log_level,
               rows_read, rows_rescued, rescued_pct, 'SUCCESS' AS status, CAST(NULL AS BIGINT) AS error_chars
        FROM ({_METRICS}) m
        UNION ALL
        SELECT 'landing_events', event_type, 'WARN', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
               CAST(NULL AS DOUBLE), 'WARN', CAST(NULL AS BIGINT)
        FROM ({_METRICS}) m WHERE rescued_pct > 0.05
        UNION ALL
        SELECT 'landing_events', 'broken_feed', 'ERROR', 0, 0, 0.0, 'FAILED',
               CAST(length('a long trace ') * 500 AS BIGINT)""",
    "source_inventory": _INVENTORY,
    "multi_table_load": """
        SELECT 'orders' AS table_name, 'SUCCESS' AS status, count(*) AS rows_written FROM orders
        UNION ALL SELECT 'customer', 'SUCCESS', count(*) FROM customer
        UNION ALL SELECT 'events', 'SUCCESS', count(*) FROM events
        UNION ALL SELECT 'missing_feed', 'FAILED', CAST(0 AS BIGINT)
        UNION ALL SELECT 'orders', 'SUCCESS', count(*) FROM orders""",
    "repair_from_worklist": f"""
        SELECT 'orders' AS table_name,
               count(*) FILTER (WHERE o_orderkey % 7 = 0) AS rows_rescued_before,
               count(*) FILTER (WHERE o_orderkey % 49 = 0) AS rows_rescued_after,
               count(*) FILTER (WHERE o_orderkey % 7 = 0 AND o_orderkey % 49 <> 0) AS rows_repaired,
               'SUCCESS' AS status
        FROM orders
        UNION ALL
        SELECT 'events', count(*) FILTER (WHERE {_RESCUED_EVENT}),
               count(*) FILTER (WHERE {_RESCUED_EVENT}), CAST(0 AS BIGINT), 'SUCCESS'
        FROM events""",
    "rescue_census": f"""
        WITH o AS (SELECT o_orderkey % 49 = 0 AS bad, o_orderkey % 3 = 0 AS other, o_orderkey % 5 = 0 AS same, o_orderkey
                   FROM orders WHERE o_orderkey % 7 = 0)
        SELECT 'orders' AS table_name, 'o_totalprice' AS column, count(*) AS rescued,
               count(*) FILTER (WHERE NOT bad AND NOT other AND same) AS held,
               count(*) FILTER (WHERE NOT bad AND NOT other AND NOT same) AS recoverable,
               count(*) FILTER (WHERE NOT bad AND other) AS conflicting, count(*) FILTER (WHERE bad) AS stuck,
               0::BIGINT AS unknown, true AS listed FROM o
        UNION ALL
        SELECT 'orders', 'no_column', count(*), 0, 0, 0, 0, count(*), false FROM o WHERE o_orderkey % 14 = 0 HAVING count(*) > 0
        UNION ALL
        SELECT 'events', 'value', count(*), 0, 0, 0, count(*), 0, false FROM events WHERE {_RESCUED_EVENT} HAVING count(*) > 0""",
    "resumed_run": """
        SELECT 'orders' AS table_name, 'SUCCESS' AS first_status, 'SKIPPED' AS second_status, count(*) AS rows_total,
               1::BIGINT AS starts, 1::BIGINT AS successes, 0::BIGINT AS failures FROM orders
        UNION ALL SELECT 'events', 'SUCCESS', 'SKIPPED', count(*), 1, 1, 0 FROM events
        UNION ALL SELECT 'customer', 'FAILED', 'SUCCESS', count(*), 2, 1, 1 FROM customer""",
    "repair_worklist": f"""
        SELECT * FROM (
            SELECT 'orders' AS table_name, 'o_orderkey' AS primary_key, 'o_totalprice' AS rescued_cols,
                   count(*) FILTER (WHERE o_orderkey % 7 = 0) AS rows_rescued FROM orders
            UNION ALL
            SELECT 'events', 'event_id', 'value', count(*) FILTER (WHERE {_RESCUED_EVENT}) FROM events
            UNION ALL
            SELECT 'customer', 'c_custkey', 'c_acctbal', CAST(0 AS BIGINT) FROM customer
        ) w WHERE rows_rescued > 0""",
}
