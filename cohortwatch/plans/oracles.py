"""DuckDB SQL for the queries of :mod:`cohortwatch.plans`."""

_NOW = "(SELECT max(ts) FROM events)"
_SILENT = f"SELECT user_id, max(ts) AS last_seen FROM events WHERE ts <= {_NOW} GROUP BY user_id HAVING max(ts) <= {_NOW} - INTERVAL 24 HOUR"

ORACLES = {
    "nested_report": """SELECT user_id, '{"to":[' || user_id || ',' || user_id || '],"mixed":[' || user_id || ',"x",true],"parts":[{"n":' || n || '},{"n":' || n || '}],"deep":{"text":"n=' || n || '"}}' AS metadata FROM (SELECT user_id, count(*) AS n FROM events WHERE value > 200 GROUP BY user_id) AS s""",
    "unresolved_tokens": """SELECT event_id, coalesce(kind, '{{ kind }}') AS kind, '{{ no.such }}' AS none, '{{ kinds.3 }}' AS far, '<' || coalesce(kind, '') || '>' AS inside FROM (SELECT event_id, CASE WHEN value <= 100 THEN event_type END AS kind FROM events) AS e""",
    "json_edge_cases": """SELECT event_id AS "offset", CASE WHEN event_id % 6 < 2 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k, CASE WHEN event_id % 6 = 4 THEN 't' || event_id END AS "timestamp", ts AS sent_at, event_id % 6 IN (2, 3) AS corrupt FROM events WHERE event_id % 6 < 5""",
    "payload_schemas": """SELECT topic, count(*) AS n, CAST(sum(f - CASE WHEN value IS NULL THEN d ELSE 0 END) AS BIGINT) AS n_set FROM events, (VALUES ('user-events', 11, 0), ('transaction-events', 10, 1), ('iot-sensor-data', 8, 1), ('wearable-device-data', 6, 1), ('web-clickstream', 12, 0), ('application-logs', 9, 0)) AS t(topic, f, d) GROUP BY topic""",
    "source_by_type": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "custom_by_group": "SELECT user_id, min(value) AS low, max(value) AS high FROM events GROUP BY user_id",
    "fixed_scores": "SELECT user_id, score, score >= 0.5 AS is_anomaly FROM (SELECT user_id, round(1 / (1 + exp(-(CAST(count(*) AS DOUBLE) / 64 + max(value) / 128 - 3))), 6) AS score FROM events GROUP BY user_id) AS s",
    "table_round_trip": 'SELECT CAST(ts AS DATE) AS "day", event_type, count(*) AS n FROM events GROUP BY ALL',
    "streaming_reports": "SELECT user_id, 'Value ' || event_id AS subject, ts AS alerted_at FROM events WHERE value > 200",
    "missing_report": f"""SELECT 'notify_missing_data' AS name, 'send_notification' AS type, 'Missing data detected for participants: [' || string_agg(CAST(user_id AS VARCHAR), ', ' ORDER BY user_id) || ']' AS message, CAST(count(*) AS INTEGER) AS n_participants FROM (SELECT user_id, (row_number() OVER (ORDER BY user_id) - 1) // 1000 AS block FROM ({_SILENT}) AS s) AS b GROUP BY block""",
    "missing_report_blocks": f"""SELECT block, any_value(n) || ' participants are silent, part ' || block || ' of ' || (any_value(n) + 3) // 4 || ': [' || string_agg(CAST(user_id AS VARCHAR), ', ' ORDER BY user_id) || ']' AS message
FROM (SELECT user_id, (row_number() OVER (ORDER BY user_id) - 1) // 4 + 1 AS block, count(*) OVER () AS n FROM ({_SILENT}) AS s) AS b GROUP BY block""",
    "streaming_roster": f"""SELECT c_custkey::BIGINT AS user_id, last_seen FROM customer LEFT JOIN (SELECT user_id, max(ts) AS last_seen FROM events GROUP BY user_id) AS l ON user_id = c_custkey WHERE last_seen IS NULL OR last_seen <= {_NOW} - INTERVAL 3 DAY""",
    "streaming_backoff": f"""WITH log AS (SELECT user_id FROM events WHERE ts <= {_NOW} - INTERVAL 24 HOUR GROUP BY user_id HAVING max(ts) <= {_NOW} - INTERVAL 48 HOUR)
SELECT user_id FROM ({_SILENT}) AS s WHERE user_id NOT IN (SELECT user_id FROM log)""",
    "table_batches": "SELECT event_id, user_id, value FROM events WHERE value > 200",
    "redelivered_messages": "SELECT 'reports' AS topic, event_id, event_type FROM events",
    "missing_24h": _SILENT,
    "missing_from_roster": f"""SELECT c_custkey::BIGINT AS user_id, last_seen FROM customer LEFT JOIN (SELECT user_id, max(ts) AS last_seen FROM events GROUP BY user_id) AS l ON user_id = c_custkey WHERE last_seen IS NULL OR last_seen <= {_NOW} - INTERVAL 3 DAY""",
    "missing_fraction_3d": f"""WITH b AS (SELECT user_id, count(DISTINCT (epoch_us({_NOW}) - epoch_us(ts)) // 86400000000) AS n FROM events WHERE ts > {_NOW} - INTERVAL 3 DAY GROUP BY user_id)
SELECT user_id, 1 - coalesce(n, 0)::DOUBLE / 3::DOUBLE AS missing_fraction FROM (SELECT DISTINCT user_id FROM events) AS u LEFT JOIN b USING (user_id)""",
    "recent_literal": f"SELECT user_id, count(*) AS n_events FROM events WHERE ts < {_NOW} - INTERVAL 10 DAY + INTERVAL 15 MINUTE GROUP BY user_id",
    "spikes_200": "SELECT user_id, count(*) AS n_spikes, max(value) AS max_value FROM events WHERE value > 200 GROUP BY user_id",
    "spike_flags": "SELECT event_id, coalesce(value > 200, false) AS is_anomaly FROM events",
    "missing_backoff": f"""WITH log AS (SELECT user_id FROM events WHERE ts <= {_NOW} - INTERVAL 24 HOUR GROUP BY user_id HAVING max(ts) <= {_NOW} - INTERVAL 48 HOUR)
SELECT user_id FROM ({_SILENT}) AS s WHERE user_id NOT IN (SELECT user_id FROM log)""",
    "quality_metrics": """SELECT 'null' AS metric, 'event_id' AS "column", avg((event_id IS NULL)::INT)::DOUBLE AS fraction FROM events
UNION ALL SELECT 'null', 'value', avg((value IS NULL)::INT) FROM events
UNION ALL SELECT 'null', 'props', avg((props IS NULL)::INT) FROM events
UNION ALL SELECT 'out_of_range', 'value', sum(coalesce((value NOT BETWEEN 0 AND 200)::INT, 0))::DOUBLE / count(*)::DOUBLE FROM events
UNION ALL SELECT 'duplicate', 'event_id', (count(*) - count(DISTINCT event_id))::DOUBLE / count(*)::DOUBLE FROM events""",
    "json_props": """SELECT event_id AS "offset", event_type AS topic, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events WHERE json_valid(props)""",
    "json_variant": """SELECT event_id AS "offset", CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS absent FROM events WHERE json_valid(props)""",
    "schema_violations": """SELECT event_type AS topic, 'null device' AS reason, count(*) AS n, 'int' AS schema FROM events GROUP BY event_type
UNION ALL SELECT event_type, 'corrupt', count(*), 'boolean' FROM events GROUP BY event_type""",
    "rendered_alert": """SELECT 'High values: [' || string_agg(CAST(user_id AS VARCHAR), ', ' ORDER BY user_id) || '], first ' || min(user_id) AS message, count(*) AS n_ids FROM (SELECT user_id, (row_number() OVER (ORDER BY user_id) - 1) // 1000 AS block FROM (SELECT DISTINCT user_id FROM events WHERE value > 300) AS u) AS b GROUP BY block""",
    "scheduled_times": "SELECT max(ts) + INTERVAL 5 MINUTE AS soon, CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) + INTERVAL 1230 MINUTE AS evening, CAST(NULL AS TIMESTAMP) AS at_once, CAST(NULL AS TIMESTAMP) AS unknown FROM events",
    "gated_reports": f"SELECT 'notify' AS name, 'send_notification' AS type, CAST(min(user_id) AS VARCHAR) AS first_id FROM ({_SILENT}) AS s HAVING count(*) > 0",
    "gate_on_long_result": "SELECT count(*) > 0 AS holds FROM events WHERE value > 300",
    "alert_table": f"""SELECT 'high_rate' AS action, 'email' AS method, user_id, 'Spikes of ' || user_id AS subject, count(*) || ' above the limit' AS body, {_NOW} + INTERVAL 5 MINUTE AS due_at, {_NOW} AS alerted_at FROM events WHERE value > 200 GROUP BY user_id""",
    "event_envelope": "SELECT CAST(user_id AS VARCHAR) AS key, event_id, event_type FROM events",
    "report_envelope": "SELECT 't-' || event_type AS topic, event_id FROM events",
    "message_text": """SELECT event_type AS topic, 0 AS "partition", event_id AS "offset", CAST(user_id AS VARCHAR) AS key, props AS value FROM events""",
    "cap_per_group": "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 2",
    "cleaned_events": "SELECT event_id, any_value(value) AS value FROM events WHERE event_id IS NOT NULL AND value BETWEEN 0 AND 200 GROUP BY event_id",
    "union_sources": "SELECT event_id, event_type, value, CASE WHEN event_type = 'purchase' THEN props END AS props FROM events WHERE event_type IS NOT NULL",
    "parsed_times": "SELECT event_id, ts FROM events",
    "saved_result": _SILENT,
    "csv_sources": "SELECT event_id, event_type, CASE WHEN event_type = 'purchase' THEN value END AS value FROM events WHERE event_type IS NOT NULL",
    "streaming_missing": f"SELECT user_id FROM ({_SILENT}) AS s",
    "streaming_repeats": "SELECT event_id, value FROM events",
    "custom_check": "SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) >= 70",
}
