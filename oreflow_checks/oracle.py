"""The registered queries as SQL for DuckDB, over the same test tables."""

from __future__ import annotations

FEED = """
feed AS (
  SELECT o_orderkey AS seq, o_custkey AS src_key,
         CASE o_orderstatus WHEN 'O' THEN 'I' WHEN 'P' THEN 'U' ELSE 'D' END AS op,
         CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS item_key,
         CASE WHEN o_orderstatus <> 'F' AND o_orderkey % 50 <> 0 THEN o_custkey % 7 + 1 END AS item_group,
         CASE WHEN o_orderkey % 97 = 0 THEN -1.0::DOUBLE ELSE o_totalprice END AS price,
         o_orderpriority || '  ' AS label,
         o_orderdate AS changed_at, o_orderdate + INTERVAL 2 HOUR AS captured_at, o_orderdate AS ingest_dt,
         'shop_db' AS source_system, 'items' AS flow_id
  FROM orders
)"""

# Feed after the silver select list; the delete-aware change time replaces the original.
SILVER = FEED + """,
silver AS (
  SELECT coalesce(item_key, src_key) AS item_key, item_group, price, label,
         CASE WHEN op = 'D' THEN captured_at ELSE changed_at END AS changed_at, op, seq
  FROM feed
  WHERE (op IN ('I', 'U') AND item_key IS NOT NULL) OR (op = 'D' AND item_key IS NULL)
)"""


def _current(condition: str = "true", rows: str = "silver") -> str:
    """Live rows of a type-1 target built from the silver rows that meet the condition."""
    return f"""(
  SELECT item_key, item_group, price, label, changed_at FROM (
    SELECT *, row_number() OVER (PARTITION BY item_key ORDER BY seq DESC) AS rn FROM {rows} WHERE {condition}
  ) WHERE rn = 1 AND op <> 'D'
)"""


SCD1 = f"WITH {SILVER} SELECT * FROM {_current()}"

FEED_DIFF = f"""WITH {SILVER}, a AS {_current('seq % 4 < 2')}, b AS {_current()}
SELECT b.* , 'insert' AS change_type FROM b WHERE item_key NOT IN (SELECT item_key FROM a)
UNION ALL SELECT a.*, 'delete' FROM a WHERE item_key NOT IN (SELECT item_key FROM b)
UNION ALL SELECT a.*, 'update_preimage' FROM a JOIN b ON a.item_key = b.item_key WHERE a IS DISTINCT FROM b
UNION ALL SELECT b.*, 'update_postimage' FROM a JOIN b ON a.item_key = b.item_key WHERE a IS DISTINCT FROM b"""

HISTORY = """
history AS (
  SELECT CAST(event_id AS VARCHAR) AS execution_id,
         'df_' || CAST(user_id % 50 AS VARCHAR) AS dataflow_id,
         'grp_' || CAST(user_id % 5 AS VARCHAR) AS dataflow_group,
         CASE event_id % 3 WHEN 0 THEN 'rdb_ingestion' WHEN 1 THEN 'bronze' ELSE 'silver' END AS stage,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
         ts AS start_time,
         ts + to_milliseconds(CAST(round(value * 10000) AS BIGINT)) AS end_time,
         value * 10 AS duration_seconds,
         CASE WHEN event_type <> 'error' THEN CAST(floor(value * 100) AS BIGINT) END AS rows_processed,
         CASE WHEN event_type = 'error' THEN 'E:' || props END AS error_message
  FROM events
)"""

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
DAY_AGO = "TIMESTAMP '2024-01-30 00:00:00'"
LIMIT = "CASE stage WHEN 'rdb_ingestion' THEN 900.0::DOUBLE WHEN 'bronze' THEN 600.0 WHEN 'silver' THEN 900.0 END"
LATEST = """
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY dataflow_id, stage ORDER BY start_time DESC, execution_id DESC) AS rn
    FROM history
  ) WHERE rn = 1
)"""

FAILURES = f"""
failures AS (
  SELECT execution_id, dataflow_id, stage, error_message, start_time, duration_seconds FROM history
  WHERE status = 'failed' AND start_time >= {DAY_AGO} AND start_time <= {NOW}
)"""


def _anomalies(z: float, exclude_latest: bool) -> str:
    skip = "AND h.execution_id NOT IN (SELECT execution_id FROM tested)" if exclude_latest else ""
    return f"""
tested AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY dataflow_id, stage ORDER BY start_time DESC, execution_id DESC) AS rn
    FROM history WHERE status = 'success' AND rows_processed IS NOT NULL
      AND start_time >= {DAY_AGO} AND start_time <= {NOW}
  ) WHERE rn = 1
),
stats AS (
  SELECT dataflow_id, stage, avg(rows_processed) AS m, stddev_samp(rows_processed) AS s, count(*) AS sample_count
  FROM history h WHERE status = 'success' AND rows_processed IS NOT NULL
    AND start_time >= TIMESTAMP '2024-01-01 00:00:00' AND start_time <= {NOW} {skip}
  GROUP BY dataflow_id, stage HAVING count(*) >= 5
),
anomalies AS (
  SELECT t.dataflow_id, t.stage, t.rows_processed AS latest_rows, round(m, 2) AS historical_avg,
         round(s, 2) AS historical_stddev, t.start_time AS latest_run_time,
         round((t.rows_processed - m) / s, 2) AS z_score, sample_count
  FROM tested t JOIN stats USING (dataflow_id, stage)
  WHERE s > 0 AND abs((t.rows_processed - m) / s) > {z}
)"""


BREACHES = f"""
breaches AS (
  SELECT execution_id, dataflow_id, stage, duration_seconds, round(duration_seconds / 60, 1) AS duration_minutes,
         {LIMIT} AS sla_limit, start_time, end_time, rows_processed
  FROM history
  WHERE status = 'success' AND start_time >= {DAY_AGO} AND start_time <= {NOW} AND duration_seconds > {LIMIT}
)"""
RATES = f"""
rates AS (
  SELECT dataflow_id, stage, count(*) AS total_runs,
         count(*) FILTER (status = 'success') AS success_count,
         count(*) FILTER (status = 'failed') AS failed_count,
         round(count(*) FILTER (status = 'success') * 100.0::DOUBLE / count(*), 2) AS success_rate_pct
  FROM history WHERE start_time >= {DAY_AGO} AND start_time <= {NOW}
  GROUP BY dataflow_id, stage
),
low_rates AS (SELECT * FROM rates WHERE total_runs >= 3 AND success_rate_pct < 80)"""
AGES = f"""
ages AS (
  SELECT dataflow_id, stage, max(start_time) AS last_run_time,
         date_sub('hour', max(start_time), {NOW}) AS hours_since_last_run
  FROM history WHERE status = 'success' AND start_time <= {NOW} GROUP BY dataflow_id, stage
)"""
STALE = AGES + """,
stale AS (SELECT * FROM ages WHERE hours_since_last_run > 2)"""

_TIME = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


def _time(column: str) -> str:
    return _TIME.format(column)


def _minutes(seconds: str) -> str:
    return f"CAST(round({seconds} / 60, 1) AS VARCHAR) || ' minutes'"


def _alert(source: str, kind: str, severity: str, title: str, message: str, details: list[tuple[str, str]]) -> str:
    entries = ", ".join(f"{{'k': '{k}', 'v': {v}}}" for k, v in details)
    return (
        f"SELECT '{kind}' AS alert_type, {severity} AS severity, {title} AS title, {message} AS message, "
        f"[{entries}] AS details, {NOW} AS timestamp FROM {source}"
    )


_NAMES = [("Dataflow ID", "dataflow_id"), ("Stage", "stage")]
_PIPE = "dataflow_id || ' (' || stage || ')'"
_WAY = "CASE WHEN z_score > 0 THEN 'surge' ELSE 'drop' END"
_PERCENT = "CAST(success_rate_pct AS VARCHAR) || '%'"
_BRANCHES = [
    _alert(
        "failures", "Pipeline Failure", "'critical'", f"'Pipeline failed: ' || {_PIPE}", "'The pipeline run failed.'",
        [*_NAMES, ("Error", "CASE WHEN length(error_message) > 0 THEN left(error_message, 200) ELSE 'No error message' END"),
         ("Timestamp", _time("start_time")), ("Duration (sec)", "CAST(duration_seconds AS VARCHAR)"),
         ("Execution ID", "execution_id")],
    ),
    _alert(
        "anomalies", "Data Quality Anomaly", "CASE WHEN abs(z_score) > 5 THEN 'critical' ELSE 'warning' END",
        f"'Row count anomaly: ' || {_PIPE} || ' - ' || {_WAY}",
        f"'Processed rows show an unusual ' || {_WAY} || ' against the average.'",
        [*_NAMES, ("Latest Rows", "format('{:,}', latest_rows)"),
         ("Historical Average", "format('{:,.2f}', historical_avg)"), ("Z-Score", "CAST(z_score AS VARCHAR)"),
         ("Deviation", "CAST(round((latest_rows - historical_avg) / nullif(historical_avg, 0) * 100, 1) AS VARCHAR) || '%'"),
         ("Sample Size", "CAST(sample_count AS VARCHAR)"), ("Timestamp", _time("latest_run_time"))],
    ),
    _alert(
        "breaches", "SLA Violation", "'warning'", f"'Stage limit exceeded: ' || {_PIPE}",
        "'The run took longer than its stage allows.'",
        [*_NAMES, ("Duration", _minutes("duration_seconds")), ("SLA Limit", _minutes("sla_limit")),
         ("Exceeded By", _minutes("(duration_seconds - sla_limit)")),
         ("Rows Processed", "CASE WHEN rows_processed <> 0 THEN format('{:,}', rows_processed) ELSE 'N/A' END"),
         ("Start Time", _time("start_time")), ("End Time", f"coalesce({_time('end_time')}, 'None')")],
    ),
    _alert(
        "low_rates", "Low Success Rate", "CASE WHEN success_rate_pct < 50 THEN 'critical' ELSE 'warning' END",
        f"'Low success rate: ' || {_PIPE} || ' - ' || {_PERCENT}",
        f"'The success rate of the last 24 hours is ' || {_PERCENT} || '.'",
        [*_NAMES, ("Success Rate", _PERCENT), ("Total Runs", "CAST(total_runs AS VARCHAR)"),
         ("Success Count", "CAST(success_count AS VARCHAR)"), ("Failed Count", "CAST(failed_count AS VARCHAR)")],
    ),
    _alert(
        "stale", "Data Freshness", "CASE WHEN hours_since_last_run > 6 THEN 'critical' ELSE 'warning' END",
        f"'Stale data: ' || {_PIPE}",
        "'The pipeline has not succeeded for ' || CAST(hours_since_last_run AS VARCHAR) || ' hours.'",
        [*_NAMES, ("Last Run", _time("last_run_time")),
         ("Hours Since Last Run", "CAST(hours_since_last_run AS VARCHAR)")],
    ),
]
ALERTS = (
    f"{HISTORY}, {FAILURES}, {_anomalies(3.0, False)}, {BREACHES}, {RATES}, {STALE},\nalerts AS (\n"
    + "\nUNION ALL\n".join(_BRANCHES) + "\n)"
)
LINES = "array_to_string(list_transform(details, lambda e: '• *' || e.k || '*: ' || e.v), chr(10))"


def _escaped(text: str) -> str:
    return f"replace(replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


_ISO = "strftime(timestamp, '%Y-%m-%dT%H:%M:%S')"
PAYLOAD = f"""
CAST(to_json({{
  'text': CASE severity WHEN 'critical' THEN '🔴' WHEN 'warning' THEN '🟡' ELSE '🔵' END || ' *' || title || '*',
  'attachments': [{{
    'color': CASE severity WHEN 'critical' THEN '#FF0000' WHEN 'warning' THEN '#FFA500' ELSE '#0000FF' END,
    'fields': [
      {{'title': 'Alert Type', 'value': alert_type, 'short': true}},
      {{'title': 'Severity', 'value': upper(severity), 'short': true}},
      {{'title': 'Message', 'value': message, 'short': false}},
      {{'title': 'Timestamp', 'value': {_ISO}, 'short': true}},
      {{'title': 'Details', 'value': {LINES}, 'short': false}}
    ]
  }}]
}}) AS VARCHAR)"""
_ROW = "'<tr><th>' || {} || '</th><td>' || {} || '</td></tr>'"
HTML = f"""
'<table style="border-left:6px solid ' || CASE severity WHEN 'critical' THEN '#FF0000' WHEN 'warning' THEN '#FFA500' ELSE '#0000FF' END
|| '"><caption>' || {_escaped('title')} || '</caption>' || {_ROW.format("'What'", "alert_type || ', ' || severity")}
|| {_ROW.format("'When'", _ISO)} || {_ROW.format("'Why'", _escaped('message'))}
|| array_to_string(list_transform(details, lambda e: {_ROW.format(_escaped('e.k'), _escaped('e.v'))}), '') || '</table>'"""

SPECS = """
specs AS (
  SELECT c_custkey AS k, 'flow_' || c_custkey AS dataflow_id, 'grp_' || c_nationkey AS dataflow_group,
         CASE WHEN c_custkey % 5 = 0 THEN false WHEN c_custkey % 5 = 1 THEN NULL ELSE true END AS enabled,
         'sys_' || c_nationkey AS connection_name, 'src.' || c_name AS source_table, 't' || c_custkey AS t
  FROM customer
)"""
# Rules of a spec as {action: {name: constraint}}; every seventh spec redefines one rule, and the last one counts.
RULE_JSON = """
'{"expect":{"has_group":"' || CASE WHEN k % 7 = 0 THEN 'item_group > 0' ELSE 'item_group IS NOT NULL' END || '"}'
|| ',"expect_or_fail":{"has_key":"item_key IS NOT NULL"}'
|| CASE WHEN k % 3 = 0 THEN ',"expect_or_drop":{"price_range":"price >= 0"}' ELSE '' END
|| CASE WHEN k % 4 = 0 THEN ',"expect_or_quarantine":{"label_set":"label <> ''''"}' ELSE '' END
|| '}'"""
VERSIONS = """
versions AS (
  SELECT sha256(CAST(o_orderkey AS VARCHAR) || c) AS version_id, 'flow_' || o_custkey AS dataflow_id,
         c AS metadata_content, o_orderdate AS created_at
  FROM (SELECT *, '{"price": ' || CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR) || '}' AS c FROM orders)
)"""
RANKED_VERSIONS = VERSIONS + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY dataflow_id ORDER BY created_at DESC, version_id DESC) AS rn FROM versions
)"""


def _metric(rule: str, action: str, ok: str) -> str:
    failed = f"count(*) FILTER (NOT coalesce({ok}, false))"
    return (
        f"SELECT '{rule}' AS rule, '{action}' AS action, count(*) - {failed} AS passed, {failed} AS failed, "
        "count(*) AS total FROM feed"
    )


HAS_KEY = "op = 'D' OR item_key IS NOT NULL"
HAS_GROUP = "op = 'D' OR item_group IS NOT NULL"
URGENT = "label NOT LIKE '1-URGENT%' OR price < 400000"
METRICS = " UNION ALL ".join([
    _metric("has_key", "fail", HAS_KEY), _metric("has_group", "warn", HAS_GROUP),
    _metric("price_range", "drop", "price >= 0"), _metric("urgent_label", "quarantine", URGENT),
])
CHECKED = "seq, op, item_key, item_group, price, label"
HELD = f"""
held AS (
  SELECT {CHECKED}, concat_ws(',', CASE WHEN item_group IS NULL THEN 'has_group' END,
                              CASE WHEN price < 0 THEN 'price_range' END) AS failed_rules
  FROM feed WHERE item_group IS NULL OR price < 0
)"""

CHECKS = f"""
raw_n AS (SELECT count(*) AS n FROM feed),
bronze_n AS (SELECT count(*) AS n FROM feed WHERE op <> 'D'),
silver_n AS (SELECT count(*) AS n FROM {_current()}),
key_nulls AS (SELECT count(*) FILTER (item_key IS NULL) AS a, count(*) FILTER (item_group IS NULL) AS b FROM feed),
key_dups AS (SELECT count(*) AS n FROM (SELECT item_key FROM feed GROUP BY item_key HAVING count(*) > 1)),
checks AS (
  SELECT t AS "table", 'table_exists' AS "check", 'PASSED' AS status, 'table exists' AS message
    FROM (VALUES ('raw_bronze'), ('bronze'), ('silver'), ('keyless')) v(t)
  UNION ALL SELECT 'gold', 'table_exists', 'FAILED', 'table does not exist'
  UNION ALL SELECT 'raw_bronze', 'record_count', 'PASSED', format('record count: {{:,}}', n) FROM raw_n
  UNION ALL SELECT 'keyless', 'record_count', 'PASSED', format('record count: {{:,}}', n) FROM raw_n
  UNION ALL SELECT 'bronze', 'record_count', 'PASSED', format('record count: {{:,}}', n) FROM bronze_n
  UNION ALL SELECT 'silver', 'record_count', 'PASSED', format('record count: {{:,}}', n) FROM silver_n
  UNION ALL SELECT 'raw_bronze', 'metadata_columns', 'FAILED', 'missing columns: run_id'
  UNION ALL SELECT 'silver', 'null_values', 'PASSED', 'no nulls in: item_key'
  UNION ALL SELECT 'keyless', 'null_values', 'FAILED', 'nulls found: item_key=' || a || ', item_group=' || b FROM key_nulls
  UNION ALL SELECT 'silver', 'duplicates', 'PASSED', 'no duplicates on: item_key'
  UNION ALL SELECT 'keyless', 'duplicates', 'FAILED', 'duplicate keys: ' || n FROM key_dups
)"""

ALL_ALERTS = f"""WITH {ALERTS}
SELECT alert_type, severity, title, message, {LINES} AS details, timestamp FROM alerts"""

ORACLE: dict[str, str] = {
    "scd1_apply_changes": SCD1,
    "scd1_incremental": SCD1,
    "scd1_overlay": SCD1,
    "scd1_stored": SCD1,
    "scd1_bucketed": SCD1,
    "scd1_stream": SCD1,
    "scd1_from_snapshot": SCD1,
    "scd1_soft_delete": f"""WITH {SILVER},
newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_key ORDER BY seq DESC) AS rn FROM silver) WHERE rn = 1),
living AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_key ORDER BY seq DESC) AS rn FROM silver WHERE op <> 'D') WHERE rn = 1
)
SELECT n.item_key, l.item_group, l.price, l.label, n.changed_at, CASE WHEN n.op = 'D' THEN 'Y' ELSE 'N' END AS is_del
FROM newest n LEFT JOIN living l USING (item_key)""",
    "change_feed_diff": FEED_DIFF,
    "merge_change_feed": FEED_DIFF,
    "ingest_incremental": f"""WITH {FEED}
SELECT seq, src_key, op, captured_at, c_custkey, c_name, c_mktsegment
FROM feed LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 10 <> 0) ON src_key = c_custkey
WHERE captured_at >= TIMESTAMP '1998-01-01 00:00:00'""",
    "param_query": """SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-05-16 12:30:15.250' AND o_orderdate < TIMESTAMP '1998-06-14 12:30:15.250'
  AND o_orderstatus = 'O' AND o_orderpriority LIKE '2-%'""",
    "bronze_flow": f"""WITH {FEED} SELECT *, {NOW} AS bronze_at FROM feed
WHERE item_key IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "silver_flow": f"""WITH {FEED},
kept AS (
  SELECT coalesce(item_key, src_key) AS item_key, item_group, price, rtrim(label) AS label,
         CASE WHEN op = 'D' THEN captured_at ELSE changed_at END AS changed_at, op, seq
  FROM feed WHERE price >= 0 AND ({URGENT})
) SELECT * FROM {_current(rows='kept')}""",
    "silver_select": f"""WITH {FEED}
SELECT item_key, src_key, item_group, price, label, changed_at AS changed_at_orig, seq, op, captured_at, ingest_dt,
       source_system, flow_id, CASE WHEN op = 'D' THEN captured_at ELSE changed_at END AS changed_at,
       CASE WHEN op = 'D' THEN 'Y' ELSE 'N' END AS is_del
FROM feed""",
    "add_metadata_columns": f"""SELECT o_orderkey, o_orderdate, '1998-06-15T12:30:15.250000' AS loaded_for,
       TIMESTAMP '1998-06-14 12:30:15.250' AS loaded_from, 'items' AS flow, 'shop_db' AS origin,
       {NOW} AS loaded_at FROM orders""",
    "rtrim_strings": f"WITH {FEED} SELECT seq, rtrim(label) AS label, op FROM feed",
    "ingest_date_window": f"""WITH {FEED} SELECT seq, op, ingest_dt FROM feed
WHERE CAST(ingest_dt AS DATE) > DATE '1998-06-14' AND CAST(ingest_dt AS DATE) <= DATE '1998-06-15'""",
    "cdc_validity_filter": f"""WITH {FEED},
broken AS (SELECT seq, src_key, op, CASE WHEN src_key % 10 <> 0 THEN item_key END AS item_key FROM feed)
SELECT * FROM broken
WHERE (op IN ('I', 'U') AND item_key IS NOT NULL) OR (op = 'D' AND item_key IS NULL)""",
    "allowlist_semi_join": f"""WITH {FEED} SELECT seq, item_key, op FROM feed
WHERE item_key IN (
  SELECT c_custkey FROM customer WHERE upper(CASE c_mktsegment WHEN 'BUILDING' THEN 'y' ELSE 'N' END) = 'Y'
)""",
    "dedup_row_number": f"""WITH {FEED} SELECT src_key, op, seq FROM feed
QUALIFY row_number() OVER (PARTITION BY src_key ORDER BY op, seq DESC) = 1""",
    "dedup_second_row": f"""WITH {FEED} SELECT src_key, op, seq FROM feed
QUALIFY row_number() OVER (PARTITION BY src_key ORDER BY op, seq DESC) = 2""",
    "enabled_dataflows": f"WITH {SPECS} SELECT dataflow_id, dataflow_group FROM specs WHERE coalesce(enabled, true)",
    "env_override": f"""WITH {SPECS}
SELECT dataflow_id, 'dev' AS raw_catalog, 'dev' AS bronze_catalog, 'dev' AS silver_catalog, 'jdbc:dev' AS jdbc_url,
       connection_name, '0 6 * * *' AS schedule_cron, 'false' AS schedule_enabled FROM specs""",
    "spec_flatten": f"""WITH {SPECS}
SELECT dataflow_id AS "dataFlowId", dataflow_group AS "dataFlowGroup", 'silver' AS layer, t || '_bronze' AS source_table,
       t || '_silver' AS target_table, 'item_key|price' AS select_list, 'item_key IS NOT NULL' AS where_list,
       'seq' AS sequence_by, {RULE_JSON} AS expectations, 'item_key' AS cluster_key, 'v1' AS version, {NOW} AS created
FROM specs
UNION ALL
SELECT dataflow_id, dataflow_group, 'bronze', t || '_raw', t || '_bronze', NULL, NULL, NULL, NULL, 'item_key', 'v1', {NOW}
FROM specs""",
    "spec_rules_by_action": f"""WITH {SPECS}
SELECT dataflow_id AS "dataFlowId", 1 AS expect, 1 AS expect_or_fail, CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS expect_or_drop,
       CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END AS expect_or_quarantine,
       2 + CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END AS rule_count
FROM specs""",
    "lineage_edges": f"""WITH {SPECS},
edges AS (
  SELECT dataflow_id, connection_name, source_table AS s, 'base.lake.' || t || '_raw' AS g FROM specs
  UNION ALL SELECT dataflow_id, connection_name, 'base.lake.' || t || '_raw', 'base.lake.' || t || '_bronze' FROM specs
  UNION ALL SELECT dataflow_id, connection_name, 'base.lake.' || t || '_bronze', 'base.lake.' || t || '_silver' FROM specs
)
SELECT sha256(dataflow_id || '|' || s || '|' || g) AS lineage_id, dataflow_id, connection_name AS source_system,
       s AS source_table, g AS target_table, 'run_1' AS execution_id, {NOW} AS created_at FROM edges""",
    "metadata_active_version": f"""WITH {RANKED_VERSIONS}
SELECT version_id, dataflow_id, metadata_content, created_at, rn = 1 AS is_active FROM ranked""",
    "metadata_current_version": f"""WITH {RANKED_VERSIONS}
SELECT dataflow_id, version_id, created_at FROM ranked WHERE rn = 1""",
    "append_schema_merge": """SELECT o_orderkey, o_orderstatus, o_totalprice,
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderstatus IN ('O', 'P') THEN NULL ELSE o_orderdate END AS o_orderdate
FROM orders""",
    "append_flows_contract": """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderstatus IN ('O', 'P', 'F')""",
    "append_flows": """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderstatus IN ('O', 'P', 'F')""",
    "partitioned_roundtrip": """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0.0::DOUBLE ELSE o_totalprice END
       AS o_totalprice, o_orderstatus FROM orders""",
    "run_history_row": f"""WITH {HISTORY}
SELECT execution_id, dataflow_id, dataflow_group, stage, status, start_time, end_time,
       date_diff('microsecond', start_time, end_time) / 1e6::DOUBLE AS duration_seconds, rows_processed, error_message,
       'dev' AS metadata, {NOW} AS created_at
FROM history""",
    "run_throughput": f"""WITH {HISTORY}
SELECT execution_id, dataflow_id, stage, rows_processed, duration_seconds,
       round(rows_processed / nullif(duration_seconds, 0), 2) AS rows_per_second
FROM history WHERE status = 'success'""",
    "latest_status": f"""WITH {HISTORY}, {LATEST}
SELECT dataflow_id, stage, status, start_time, end_time, duration_seconds, rows_processed, error_message FROM latest""",
    "complete_dataflow": f"""WITH {HISTORY}, {LATEST},
lineage AS (
  SELECT DISTINCT 'df_' || CAST(user_id % 50 AS VARCHAR) AS dataflow_id, 'shop_db' AS source_system,
         'src.' || user_id AS source_table, 'lake.' || user_id AS target_table FROM events
)
SELECT dataflow_id, source_system, source_table, target_table, status, start_time, end_time, rows_processed
FROM lineage LEFT JOIN latest USING (dataflow_id)""",
    "dq_metrics": f"WITH {FEED} {METRICS}",
    "dq_like_rule": f"""WITH {FEED}
{_metric('label_form', 'warn', "label LIKE '%-%'")} UNION ALL {_metric('label_high', 'warn', "label LIKE '2-HIGH%'")}""",
    "dq_event_log": f"""WITH {FEED}, m AS ({METRICS})
SELECT {NOW} AS timestamp, 'items' AS dataflow_id, rule, passed, failed FROM m""",
    "dq_drop": f"WITH {FEED} SELECT {CHECKED} FROM feed WHERE price >= 0",
    "dq_kept": f"WITH {FEED} SELECT {CHECKED} FROM feed WHERE price >= 0 AND ({URGENT})",
    "dq_quarantine": f"WITH {FEED}, {HELD} SELECT * FROM held",
    "dq_fail_gate": f"""WITH {FEED}
SELECT 'has_key' AS rule, count(*) AS failed FROM feed WHERE item_key IS NULL HAVING count(*) > 0""",
    "dq_reprocess": f"""WITH {FEED}, {HELD}
SELECT seq, op, item_key, coalesce(item_group, 0) AS item_group, abs(price) AS price, label FROM held WHERE op <> 'D'""",
    "violation_type_counts": f"""WITH {FEED}
SELECT CASE WHEN item_key IS NULL THEN 'key_null' WHEN item_group IS NULL THEN 'group_null' ELSE 'normal' END
       AS violation_type, count(*) AS rows FROM feed GROUP BY 1""",
    "count_by_operation": f"WITH {FEED} SELECT op, count(*) AS rows FROM feed GROUP BY op",
    "count_by_day": f"WITH {FEED} SELECT ingest_dt, count(*) AS rows FROM feed GROUP BY 1",
    "val_record_count": "SELECT count(*) AS record_count FROM orders",
    "val_null_counts": f"""WITH {FEED}
SELECT 'item_key' AS column_name, count(*) FILTER (item_key IS NULL) AS null_count FROM feed
UNION ALL SELECT 'item_group', count(*) FILTER (item_group IS NULL) FROM feed
UNION ALL SELECT 'seq', count(*) FILTER (seq IS NULL) FROM feed""",
    "val_duplicates": """SELECT 'o_custkey' AS key, count(*) AS duplicate_keys
FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'o_orderkey', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)""",
    "val_checks": f"WITH {SILVER}, {CHECKS} SELECT * FROM checks",
    "val_touched": "\nUNION ALL\n".join(
        f"SELECT {n} AS batch, sum(c)::bigint AS rows, sum(m)::bigint AS nulls, count(*) FILTER (c > 1) AS duplicates FROM ("
        f"SELECT count(*) AS c, count(*) FILTER (o_orderpriority IS NULL) AS m FROM orders WHERE o_orderkey % 4 <= {n} "
        "GROUP BY o_custkey, o_orderpriority)" for n in range(4)),
    "val_report": f"""WITH {SILVER}, {CHECKS}
SELECT 'items' AS dataflow_id, {NOW} AS timestamp, 'FAILED' AS overall_status, count(*) AS total_checks,
       count(*) FILTER (status = 'PASSED') AS passed_checks, count(*) FILTER (status = 'FAILED') AS failed_checks,
       string_agg("table" || '|' || "check" || '|' || status || '|' || message, chr(10) ORDER BY "table", "check", status) AS listed,
       'FAILED/' || count(*) || '/' || count(*) FILTER (status = 'PASSED') || '/' || count(*) FILTER (status = 'FAILED') AS counted
FROM checks""",
    "mon_failures": f"WITH {HISTORY}, {FAILURES} SELECT * FROM failures",
    "mon_anomalies": f"WITH {HISTORY}, {_anomalies(3.0, False)} SELECT * FROM anomalies",
    "mon_anomalies_sensitive": f"WITH {HISTORY}, {_anomalies(1.0, True)} SELECT * FROM anomalies",
    "mon_sla": f"WITH {HISTORY}, {BREACHES} SELECT * FROM breaches",
    "mon_success_rate": f"WITH {HISTORY}, {RATES} SELECT * FROM low_rates",
    "mon_freshness": f"WITH {HISTORY}, {STALE} SELECT * FROM stale",
    "mon_freshness_by_frequency": f"""WITH {HISTORY}, {AGES},
expected AS (SELECT dataflow_id FROM history GROUP BY 1 HAVING max(duration_seconds) < 2500)
SELECT dataflow_id, stage, last_run_time, hours_since_last_run FROM ages
WHERE CASE WHEN dataflow_id IN (SELECT dataflow_id FROM expected)
           THEN date_sub('second', last_run_time, {NOW}) > 36000 ELSE hours_since_last_run > 2 END""",
    "mon_alerts": ALL_ALERTS,
    "mon_alerts_folded": ALL_ALERTS,
    "mon_day_moments": f"""WITH {HISTORY}
SELECT dataflow_id, stage, count(*) AS runs, count(*) FILTER (status = 'success') AS succeeded, count(*) FILTER (status = 'failed') AS failed,
       count(rows_processed) FILTER (status = 'success') AS n, round(avg(rows_processed) FILTER (status = 'success'), 6) AS mean,
       round(stddev_samp(rows_processed) FILTER (status = 'success'), 6) AS spread,
       max(start_time) FILTER (status = 'success') AS last_success
FROM history GROUP BY ALL""",
    "mon_alert_summary": f"""WITH {ALERTS}
SELECT count(*) FILTER (severity = 'critical') AS critical_count, count(*) FILTER (severity = 'warning') AS warning_count,
       count(*) FILTER (severity = 'info') AS info_count, count(*) AS alert_count FROM alerts""",
    "mon_level_filter": f"WITH {ALERTS} SELECT alert_type, severity, title FROM alerts WHERE severity = 'critical'",
    "mon_alert_payload": f"WITH {ALERTS} SELECT alert_type, {PAYLOAD} AS payload FROM alerts",
    "mon_alert_html": f"WITH {ALERTS} SELECT alert_type, {HTML} AS html FROM alerts",
    "mon_history_row": f"""WITH {ALERTS}, t AS (SELECT alert_type, count(*) AS n FROM alerts GROUP BY 1)
SELECT 'run_1' AS run_id, DATE '2024-01-31' AS monitoring_date, 24 AS monitoring_window_hours, CAST(count(*) AS INT) AS alert_count,
       CAST(count(*) FILTER (severity = 'critical') AS INT) AS critical_count,
       CAST(count(*) FILTER (severity = 'warning') AS INT) AS warning_count,
       (SELECT '{{' || string_agg('"' || alert_type || '":' || n, ',' ORDER BY alert_type) || '}}' FROM t) AS alerts_json FROM alerts""",
    "mon_alert_rows": f"""WITH {ALERTS}
SELECT 'run_1' AS run_id, DATE '2024-01-31' AS monitoring_date, alert_type, severity, title, message, {LINES} AS details,
       {_ISO} AS timestamp, true AS same_type FROM alerts""",
    "dedup_stream": f"""WITH {FEED}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY src_key ORDER BY op, seq DESC) AS rn FROM feed
) SELECT CAST(rn AS INT) AS n, src_key, op, seq FROM ranked WHERE rn <= 2""",
    "silver_key_gate": f"""WITH {FEED}, spoilt AS (
  SELECT seq, op, src_key, CASE WHEN seq % 11 <> 0 THEN item_key END AS item_key FROM feed
), cases AS (SELECT * FROM spoilt, (VALUES (true), (false)) AS f(fallback))
SELECT fallback, CASE WHEN item_key IS NOT NULL OR (op = 'D' AND fallback) THEN 'applied' ELSE 'held' END AS what, seq, op,
       CASE WHEN op = 'D' AND fallback THEN coalesce(item_key, src_key) ELSE item_key END AS item_key
FROM cases""",
    "metadata_rollback": """WITH proposed AS (
  SELECT sha256(o_custkey || ':' || o_orderstatus) AS version_id, 'flow_' || o_custkey AS dataflow_id, o_orderstatus AS metadata_content,
         o_orderdate + to_seconds(o_orderkey) AS created_at FROM orders
), marked AS (
  SELECT *, lag(version_id) OVER (PARTITION BY dataflow_id ORDER BY created_at, version_id) AS before FROM proposed
), kept AS (SELECT * FROM marked WHERE version_id IS DISTINCT FROM before)
SELECT version_id, dataflow_id, metadata_content, created_at,
       row_number() OVER (PARTITION BY dataflow_id ORDER BY created_at DESC, version_id DESC) = 1 AS is_active FROM kept""",
    "dash_run_status": f"""WITH {HISTORY}
SELECT dataflow_id, stage, count(*) AS total_runs, count(*) FILTER (status = 'success') AS success_count,
       round(avg(duration_seconds), 4) AS avg_duration, max(start_time) AS last_run
FROM history WHERE start_time >= TIMESTAMP '2024-01-13 00:00:00' AND start_time <= TIMESTAMP '2024-01-20 12:00:00'
GROUP BY dataflow_id, stage""",
    "recent_runs_top10": f"""WITH {HISTORY}
SELECT execution_id, dataflow_id, stage, status, start_time, duration_seconds, rows_processed FROM history
ORDER BY start_time DESC, execution_id DESC LIMIT 10""",
    "weekly_review": f"""WITH {HISTORY}
SELECT CAST(date_trunc('week', start_time) AS DATE) AS week, stage, count(*) AS runs,
       round(avg(duration_seconds), 4) AS avg_duration, CAST(sum(rows_processed) AS BIGINT) AS rows_processed,
       round(count(*) FILTER (status = 'failed') * 100.0::DOUBLE / count(*), 2) AS error_rate_pct
FROM history GROUP BY 1, 2""",
    "sla_attainment": f"""WITH {HISTORY}
SELECT CAST(date_trunc('month', start_time) AS DATE) AS month, stage, count(*) AS runs,
       count(*) FILTER (duration_seconds <= {LIMIT}) AS within_limit,
       round(count(*) FILTER (duration_seconds <= {LIMIT}) * 100.0::DOUBLE / count(*), 2) AS attainment_pct
FROM history WHERE status = 'success' GROUP BY 1, 2""",
}
