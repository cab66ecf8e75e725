"""DuckDB SQL that computes each registered query independently.

The oracle never parses JSON: it replays the message derivation from
``events`` with ``event_id % 20`` / ``% 40`` / ``% 30`` arithmetic, so a
mistake in the Spark parser cannot hide in both sides.
"""

from __future__ import annotations

from spindle.operators.metrics import CATALOG

EV = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract(props, '$.k') AS BIGINT) AS props_k,
         event_id % 20 AS k, event_id % 40 AS k40,
         'evt-' || CAST(event_id AS VARCHAR) AS eid,
         'msg-' || CAST(event_id AS VARCHAR) AS message_id,
         ts + to_seconds(event_id % 30) AS publish_time,
         'batch-' || CAST(event_id // 100 AS VARCHAR) AS batch_id
  FROM events
),
cls AS (
  SELECT *,
    CASE WHEN k40 = 20 THEN 'invalid_utf8'
         WHEN k = 0 OR k = 7 THEN 'json_syntax'
         WHEN k = 5 THEN 'not_object'
         WHEN k = 1 THEN 'missing_fields'
         WHEN k = 2 THEN 'bad_timestamp'
         WHEN k = 3 THEN 'metadata_not_object'
         WHEN k = 4 THEN 'metadata_missing_fields'
         WHEN k = 6 THEN 'required_null' END AS reject_reason,
    k NOT IN (0, 5, 7) AS parsed_ok,
    k NOT IN (0, 1, 2, 3, 4, 5, 7) AS validator_ok
  FROM ev
),
landed AS (SELECT * FROM cls WHERE reject_reason IS NULL),
outc AS (
  SELECT message_id, CASE WHEN k <> 6 AND parsed_ok AND k <> 1 THEN eid END AS event_id,
         CASE WHEN parsed_ok AND k <> 2 THEN ts END AS timestamp,
         CASE WHEN reject_reason IS NULL THEN publish_time END AS processing_timestamp,
         batch_id, publish_time, reject_reason, ts, event_type, value
  FROM cls
)"""


def w(body: str) -> str:
    return "WITH " + EV.strip() + "\n" + body


ORACLE: dict[str, str] = {}

ORACLE["publish_envelope"] = w("""
SELECT message_id, eid AS event_id, user_id, event_type, value, props_k,
       'user-' || CAST(user_id AS VARCHAR) AS ordering_key, batch_id FROM ev""")

# The next batch begins at the least of three places; from there on the pointers are followed.
ORACLE["publish_batches"] = """
WITH RECURSIVE m AS (SELECT event_type AS key, ts, octet_length(encode(props))::BIGINT AS size, event_id,
    row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events),
p AS (SELECT *, (sum(size) OVER (PARTITION BY key ORDER BY rn))::BIGINT - size AS s, epoch_us(ts) AS us FROM m),
r AS (SELECT *, max(rn) OVER (PARTITION BY key ORDER BY s RANGE BETWEEN CURRENT ROW AND 240 FOLLOWING) AS last_fit,
             1 + max(rn) OVER (PARTITION BY key ORDER BY us RANGE BETWEEN CURRENT ROW AND 14400000000 FOLLOWING) AS by_time FROM p),
n AS (SELECT r.key, r.rn, greatest(r.rn + 1, least(r.rn + 25, r.by_time,
             CASE WHEN e.s + e.size - r.s > 240 THEN e.rn ELSE e.rn + 1 END)) AS following
      FROM r JOIN r e ON r.key IS NOT DISTINCT FROM e.key AND e.rn = r.last_fit),
starts AS (SELECT key, 1::BIGINT AS rn, 0::BIGINT AS batch FROM m WHERE rn = 1
           UNION ALL SELECT n.key, n.following, batch + 1 FROM starts JOIN n ON starts.key IS NOT DISTINCT FROM n.key AND starts.rn = n.rn
           WHERE EXISTS (SELECT 1 FROM m WHERE m.key IS NOT DISTINCT FROM n.key AND m.rn = n.following)),
spans AS (SELECT *, lead(rn) OVER (PARTITION BY key ORDER BY batch) AS next_rn FROM starts)
SELECT spans.key AS ordering_key, batch, count(*) AS messages, sum(size)::BIGINT AS bytes, min(ts) AS first_time, max(ts) AS last_time
FROM spans JOIN m ON spans.key IS NOT DISTINCT FROM m.key AND m.rn >= spans.rn AND (next_rn IS NULL OR m.rn < next_rn)
GROUP BY 1, 2"""

ORACLE["parse_json"] = w("SELECT message_id, parsed_ok FROM cls")

ORACLE["enrich_processing_ts"] = w(
    "SELECT message_id, publish_time AS processing_timestamp FROM cls WHERE parsed_ok")

ORACLE["validate_required"] = w(
    "SELECT message_id, k <> 1 AS has_required FROM cls WHERE parsed_ok")

ORACLE["validate_timestamp"] = w("""
SELECT message_id, k <> 2 AS ts_ok, CASE WHEN k <> 2 THEN ts END AS timestamp
FROM cls WHERE parsed_ok AND k <> 1""")

ORACLE["ingest_valid"] = w("""
SELECT CASE WHEN k <> 6 THEN eid END AS event_id, ts AS timestamp, publish_time AS processing_timestamp,
       event_type AS source, '1.0' AS version, user_id, value
FROM cls WHERE validator_ok""")

ORACLE["reject_reasons"] = w("""
SELECT reject_reason, count(*) AS n FROM cls WHERE reject_reason IS NOT NULL GROUP BY reject_reason""")

ORACLE["conform_schema"] = w("""
SELECT eid AS event_id, ts AS timestamp, publish_time AS processing_timestamp, user_id, event_type,
       value, props_k, event_type AS source, '1.0' AS version
FROM landed""")

ORACLE["conform_flat"] = w("""
SELECT eid AS event_id, ts AS timestamp,
       '{"event_type":"' || event_type || '","props":{"k":' || CAST(props_k AS VARCHAR)
         || '},"user_id":' || CAST(user_id AS VARCHAR) || ',"value":' || CASE WHEN value = floor(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR)
                                ELSE CAST(value AS VARCHAR) END || '}' AS data,
       publish_time AS processing_timestamp
FROM landed""")

ORACLE["table_rows"] = w("SELECT eid AS event_id, ts AS timestamp FROM landed")

ORACLE["insert_errors"] = w("""
SELECT ts AS timestamp, 'event_id' AS error_field, 'required_null' AS error FROM cls WHERE k = 6""")

ORACLE["nested_lookup"] = w("SELECT eid AS event_id, event_type = 'purchase' AS matches FROM landed")

SHARES = """
shared AS (SELECT eid AS event_id, user_id, event_type, value, (user_id % 4) AS u,
                  unnest(CASE user_id % 4 WHEN 1 THEN [0] WHEN 2 THEN [0, 1, 2] WHEN 3 THEN [NULL]::INTEGER[] ELSE []::INTEGER[] END) AS share
           FROM landed)"""

ORACLE["hook_rows"] = "WITH " + EV.strip() + "," + SHARES + """
SELECT event_id, share, round(CASE u WHEN 1 THEN round(value, 6) WHEN 2 THEN round(value / 3, 6) END, 9) AS amount,
       CASE WHEN u < 3 THEN event_type END AS kind,
       CASE WHEN u = 3 THEN 'ValueError: no shares for user ' || CAST(user_id AS VARCHAR) END AS hook_error FROM shared"""

ORACLE["errors_all_stages"] = "WITH " + EV.strip() + "," + SHARES + """
SELECT stage, count(*) AS n FROM (
  SELECT CASE WHEN reject_reason IN ('invalid_utf8', 'json_syntax', 'not_object') THEN 'parsing'
              WHEN reject_reason = 'required_null' THEN 'storage' ELSE 'validation' END AS stage
  FROM cls WHERE reject_reason IS NOT NULL
  UNION ALL SELECT 'processing' FROM shared WHERE u = 3
  UNION ALL SELECT 'storage' FROM shared WHERE u IN (1, 2) AND round(round(value / CASE u WHEN 1 THEN 1 ELSE 3 END, 6), 2) >= 100
) GROUP BY 1"""

ORACLE["message_counts"] = w("""
SELECT count(*) AS sent, count(processing_timestamp) AS processed FROM outc
WHERE timestamp BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'""")

ORACLE["message_counts_landed"] = w("""
SELECT count(*) AS sent, count(publish_time) AS processed FROM landed
WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'""")

ORACLE["message_counts_batch"] = w("""
SELECT count(*) AS sent, count(processing_timestamp) AS processed FROM outc
WHERE timestamp BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'
  AND batch_id = 'batch-42'""")

ORACLE["recent_count"] = w("""
SELECT count(*) AS n FROM landed WHERE ts >= TIMESTAMP '2024-01-16 00:00:00' - INTERVAL 1 MINUTE""")

ORACLE["point_lookup"] = w("""
SELECT eid AS event_id, ts AS timestamp, publish_time AS processing_timestamp,
       event_type AS source, '1.0' AS version, user_id, value
FROM landed WHERE eid = 'evt-28'""")

ORACLE["prefix_count"] = w("""
SELECT count(*) AS n FROM landed
WHERE eid LIKE 'evt-9%' AND ts >= TIMESTAMP '2024-01-16 00:00:00' - INTERVAL 1 MINUTE""")

ORACLE["sample_rows"] = w("""
SELECT eid AS event_id, ts AS timestamp FROM landed ORDER BY eid LIMIT 10""")

ORACLE["end_to_end_latency"] = w("""
SELECT eid AS event_id, round(CAST(event_id % 30 AS DOUBLE), 9) AS latency_s FROM landed""")

ORACLE["tumbling_counts"] = w("""
SELECT time_bucket(INTERVAL 60 SECOND, ts) AS window_start, event_type, count(*) AS n
FROM landed GROUP BY 1, 2""")

ORACLE["duplicate_ids"] = w("SELECT eid AS event_id, 2 AS n FROM landed")

ORACLE["reconcile"] = w("SELECT eid AS event_id FROM cls WHERE reject_reason IS NOT NULL")


# ---------------------------------------------------------------- metrics

BASE_SERIES = "'{\"environment\":\"test\",\"service\":\"spindle\"}'"
X_SERIES = "'{\"environment\":\"test\",\"event_type\":\"' || event_type || '\",\"service\":\"spindle\"}'"


def bucket(t: str, p: int) -> str:
    return f"make_timestamp((epoch_us({t}) // {p * 1000000}) * {p * 1000000})"


STAGE = """CASE WHEN reject_reason IN ('invalid_utf8', 'json_syntax', 'not_object') THEN 'parsing'
            WHEN reject_reason = 'required_null' THEN 'storage'
            ELSE 'validation' END"""

PTS = """
pts AS (
  SELECT 'counter/messages_received' AS metric_type, 'CUMULATIVE' AS metric_kind, 'INT64' AS value_type,
         1.0 AS value, {base} AS series, publish_time AS end_time FROM cls
  UNION ALL
  SELECT 'counter/messages_processed', 'CUMULATIVE', 'INT64', 1.0, {base}, publish_time FROM cls
  WHERE reject_reason IS NULL
  UNION ALL
  SELECT 'latency/end_to_end_latency', 'GAUGE', 'DOUBLE', CAST(event_id % 30 AS DOUBLE), {base}, publish_time
  FROM cls WHERE reject_reason IS NULL
  UNION ALL
  SELECT 'counter/messages_failed', 'CUMULATIVE', 'INT64', 1.0, {base}, publish_time FROM cls
  WHERE reject_reason IS NOT NULL
  UNION ALL
  SELECT 'counter/errors/' || reject_reason, 'CUMULATIVE', 'INT64', 1.0,
         '{{"environment":"test","reason":"' || reject_reason || '","service":"spindle"}}', publish_time
  FROM cls WHERE reject_reason IS NOT NULL
  UNION ALL
  SELECT 'counter/' || {stage} || '_errors', 'CUMULATIVE', 'INT64', 1.0, {base}, publish_time
  FROM cls WHERE reject_reason IS NOT NULL
)""".format(base=BASE_SERIES, stage=STAGE)

XP_ALL = f"xp AS (SELECT {X_SERIES} AS series, event_type, value, ts AS end_time FROM events)"
# The points of the messages that are processed.
XP = f"xp AS (SELECT {X_SERIES} AS series, event_type, value, ts AS end_time FROM events WHERE event_id % 20 >= 8)"


def wm(body: str, ctes: str = "", xp: str = XP) -> str:
    extra = ",\n" + ctes.strip() if ctes else ""
    return "WITH " + EV.strip() + ",\n" + PTS.strip() + ",\n" + xp + extra + "\n" + body


ORACLE["metrics_points"] = wm("""
SELECT metric_type, metric_kind, value_type, round(value, 9) AS value, series, end_time FROM pts""")

ORACLE["typed_points"] = """
SELECT 'counter/offset' AS metric_type, 'CUMULATIVE' AS metric_kind, 'INT64' AS value_type, event_id + 9007199254740993 AS int64_value,
       NULL::DOUBLE AS double_value, NULL::BOOLEAN AS bool_value, ts AS end_time FROM events
UNION ALL SELECT 'gauge/value', 'GAUGE', 'DOUBLE', NULL, value, NULL, ts FROM events WHERE value IS NOT NULL
UNION ALL SELECT 'gauge/value_whole', 'GAUGE', 'INT64', trunc(value)::BIGINT, NULL, NULL, ts FROM events WHERE value IS NOT NULL
UNION ALL SELECT 'gauge/is_error', 'GAUGE', 'BOOL', NULL, NULL, event_type = 'error', ts FROM events WHERE event_type IS NOT NULL"""

ORACLE["metric_scan"] = wm("""
SELECT series, value, end_time FROM xp
WHERE end_time BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'""", xp=XP_ALL)

ORACLE["metric_stats"] = "WITH " + EV.strip() + ",\n" + XP_ALL + """,
req AS (SELECT event_type FROM events
        UNION SELECT unnest(['click','error','purchase','signup','view','refund'])),
st AS (SELECT event_type, count(value) AS n, avg(value) AS mean FROM xp
       WHERE end_time BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'
       GROUP BY event_type)
SELECT req.event_type, coalesce(n, 0) AS n, round(coalesce(mean, 0.0), 9) AS mean
FROM req LEFT JOIN st ON req.event_type IS NOT DISTINCT FROM st.event_type"""

_PCT = """
, r AS (SELECT series, value, row_number() OVER (PARTITION BY series ORDER BY value) AS rn,
               count(*) OVER (PARTITION BY series) AS n FROM xp),
ps AS (SELECT unnest([0.5, 0.95, 0.99]::DOUBLE[]) AS p)
SELECT series, p, value FROM r, ps WHERE rn = floor(n * p) + 1"""
ORACLE["metric_percentiles"] = "WITH " + XP_ALL + _PCT.replace("\n, r AS", ",\nr AS", 1)

ORACLE["aligned_mean"] = "WITH " + XP_ALL + f"""
SELECT series, {bucket('end_time', 3600)} AS bucket, round(avg(value), 9) AS mean, count(*) AS n
FROM xp GROUP BY 1, 2"""

ORACLE["outcome_counts"] = w(f"""
SELECT {bucket('publish_time', 3600)} AS bucket, count(*) AS received,
       count(*) FILTER (WHERE reject_reason IS NULL) AS processed,
       count(*) FILTER (WHERE reject_reason IS NOT NULL) AS failed
FROM cls GROUP BY 1""")

ORACLE["errors_by_stage"] = w(f"""
SELECT {STAGE} AS stage, count(*) AS n
FROM cls WHERE reject_reason IS NOT NULL GROUP BY 1""")

ORACLE["batch_stats"] = w("""
SELECT batch_id, count(*) AS batch_size,
       round((epoch_us(max(publish_time)) - epoch_us(min(publish_time))) / 1e6, 9) AS span_s
FROM cls GROUP BY batch_id""")

_PANELS = {
    **{f"messages_{x}": (f"counter/messages_{x}", "sum") for x in ("received", "processed", "failed")},
    **{f"{x}_latency": (f"latency/{x}_latency", "avg") for x in ("processing", "end_to_end")},
    **{f"{x}_errors": (f"counter/{x}_errors", "sum") for x in ("parsing", "validation", "processing", "storage")},
    **{f"{x}_usage": (f"gauge/{x}_usage", "avg") for x in ("cpu", "memory", "disk")},
}
_PANEL_SQL = ",\n  ".join(
    f"round(coalesce(sum(value) FILTER (WHERE metric_type = '{t}'), 0.0), 9) AS {name}" if how == "sum"
    else f"round(avg(value) FILTER (WHERE metric_type = '{t}'), 9) AS {name}" for name, (t, how) in _PANELS.items())

ORACLE["dashboard_rollup"] = wm(f"""
SELECT {bucket('end_time', 3600)} AS bucket,
  {_PANEL_SQL}
FROM allp
WHERE metric_type IN ({", ".join(f"'{t}'" for t, _ in _PANELS.values())})
GROUP BY 1""", ctes="""
allp AS (SELECT metric_type, value, end_time FROM pts
         UNION ALL SELECT 'latency/processing_latency', value, end_time FROM xp)""")

_MSG = {
    "invalid_utf8": "Error processing message",
    "json_syntax": "Failed to parse JSON message",
    "not_object": "Error processing message",
    "missing_fields": "Message missing required fields",
    "bad_timestamp": "Invalid timestamp format",
    "metadata_not_object": "Metadata must be a dictionary",
    "metadata_missing_fields": "Metadata missing required fields: source, version",
    "required_null": "Required field is null",
}
_MSG_CASE = "CASE " + " ".join(f"WHEN reject_reason = '{k}' THEN '{v}'" for k, v in _MSG.items()) + " END"

ORACLE["reject_log_rows"] = w(f"""
SELECT 'ERROR' AS severity, 'error' AS level, {_MSG_CASE} AS message, 'spindle.ingest' AS logger,
       reject_reason AS reason, message_id,
       '{{"message":"' || {_MSG_CASE} || '","severity":"ERROR","timestamp":"'
         || strftime(publish_time, '%Y-%m-%dT%H:%M:%S.%fZ') || '","logger":"spindle.ingest","reason":"'
         || reject_reason || '","message_id":"' || message_id || '"}}' AS log
FROM cls WHERE reject_reason IS NOT NULL""")


# ---------------------------------------------------------------- alerts


def islands(name: str, rule: str, bucketed: str, op: str, th: float, dur: int, period: int,
            fill: bool = False) -> tuple[str, str]:
    """CTEs + final SELECT of sustained breaches for one rule (gaps and islands)."""
    ctes = f"{name}_b AS ({bucketed})"
    src = f"{name}_b"
    if fill:
        ctes += f""",
{name}_span AS (SELECT min(b) AS lo, max(b) AS hi FROM (SELECT {bucket('publish_time', period)} AS b FROM cls)),
{name}_grid AS (SELECT s.series, unnest(generate_series(lo, hi, INTERVAL {period} SECOND)) AS bucket
                FROM (SELECT DISTINCT series FROM {name}_b) s, {name}_span),
{name}_f AS (SELECT g.series, g.bucket, coalesce(b.value, 0.0) AS value
             FROM {name}_grid g LEFT JOIN {name}_b b USING (series, bucket))"""
        src = f"{name}_f"
    ctes += f""",
{name}_br AS (SELECT series, bucket,
                epoch(bucket) - {period} * row_number() OVER (PARTITION BY series ORDER BY bucket) AS g
              FROM {src} WHERE value {op} {th}),
{name}_rr AS (SELECT series, min(bucket) AS start_time, max(bucket) + INTERVAL {period} SECOND AS end_time,
                count(*) AS buckets FROM {name}_br GROUP BY series, g)"""
    sel = (f"SELECT '{rule}' AS rule, series, start_time, end_time, buckets FROM {name}_rr "
           f"WHERE buckets * {period} >= {dur}")
    return ctes, sel


def alert_sql(parts: list[tuple[str, str]], xp: str = XP) -> str:
    ctes = ",\n".join(c for c, _ in parts)
    sels = "\nUNION ALL\n".join(s for _, s in parts)
    return "WITH " + EV.strip() + ",\n" + PTS.strip() + ",\n" + xp + ",\n" + ctes + "\n" + sels


def _lat_b(p=3600):
    return f"SELECT series, {bucket('end_time', p)} AS bucket, avg(value) AS value FROM xp GROUP BY 1, 2"


def _pts_b(mtype, agg, p=3600):
    return (f"SELECT series, {bucket('end_time', p)} AS bucket, {agg}(value) AS value FROM pts "
            f"WHERE metric_type = '{mtype}' GROUP BY 1, 2")


_ERR_B = (f"SELECT {BASE_SERIES} AS series, {bucket('publish_time', 3600)} AS bucket, "
          "avg(CASE WHEN reject_reason IS NOT NULL THEN 1.0 ELSE 0.0 END) AS value FROM cls GROUP BY 1, 2")

ORACLE["alerts_latency"] = alert_sql([islands("lat", "processing_latency", _lat_b(), ">", 30.0, 18000, 3600)], XP_ALL)
ORACLE["alerts_error_rate"] = alert_sql([islands("er", "error_rate", _ERR_B, ">", 0.4, 10800, 3600)])
ORACLE["alerts_low_throughput"] = alert_sql([
    islands("lt", "low_throughput", _pts_b("counter/messages_processed", "sum"), "<", 8.0, 10800, 3600,
            fill=True)])
ORACLE["alerts_multi_rule"] = alert_sql([
    islands("lat", "processing_latency", _lat_b(), ">", 50.0, 10800, 3600),
    islands("e2e", "end_to_end_latency", _pts_b("latency/end_to_end_latency", "avg"), ">", 18.0, 7200, 3600),
    islands("er", "error_rate", _ERR_B, ">", 0.45, 7200, 3600),
    islands("lt", "low_throughput", _pts_b("counter/messages_processed", "sum"), "<", 7.0, 7200, 3600,
            fill=True),
], XP_ALL)

# A bucket counts when it ends before the last watermark, 300 s behind the last point.
_CLOSED = f"""SELECT series, bucket, value FROM ({_lat_b()}), (SELECT max(end_time) - INTERVAL 300 SECOND AS mark FROM xp)
      WHERE bucket + INTERVAL 1 HOUR <= mark"""
_EVENT_CTES, _ = islands("lat", "processing_latency", _CLOSED, ">", 20.0, 10800, 3600)
ORACLE["stream_alert_events"] = "WITH " + XP + ",\n" + _EVENT_CTES + """,
mark AS (SELECT max(end_time) - INTERVAL 300 SECOND AS at FROM xp),
held AS (SELECT * FROM lat_rr WHERE buckets >= 3)
SELECT 'processing_latency' AS rule, series, 'raised' AS event, start_time, start_time + INTERVAL 3 HOUR AS at, 3 AS buckets FROM held
UNION ALL
SELECT 'processing_latency', series, 'cleared', start_time, end_time, buckets FROM held, mark
WHERE end_time + INTERVAL 1 HOUR <= mark.at"""

ORACLE["ordered_delivery"] = w("""
SELECT 'user-' || CAST(user_id AS VARCHAR) AS ordering_key,
       row_number() OVER (PARTITION BY user_id ORDER BY publish_time, message_id) - 1 AS delivery, message_id, publish_time
FROM ev WHERE epoch_us(publish_time) <= (SELECT epoch_ms(max(publish_time)) * 1000 - 300000000 FROM ev)""")

# ---------------------------------------------------------------- runs

RUNS = """
hours AS (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)),
                                        INTERVAL 1 HOUR)) AS start_time FROM events),
runs AS (SELECT 'run-' || strftime(start_time, '%Y%m%d%H') AS test_name, start_time,
                start_time + INTERVAL 1 HOUR AS end_time FROM hours),
rmsg AS (SELECT r.test_name, count(*) AS sent, count(*) FILTER (WHERE c.reject_reason IS NULL) AS processed,
                count(*) FILTER (WHERE c.reject_reason IS NOT NULL) AS errors
         FROM runs r JOIN cls c ON c.publish_time >= r.start_time AND c.publish_time < r.end_time
         GROUP BY 1),
rlat AS (SELECT r.test_name, e.value,
                row_number() OVER (PARTITION BY r.test_name ORDER BY e.value) AS rn,
                count(*) OVER (PARTITION BY r.test_name) AS n
         FROM runs r JOIN events e ON e.ts >= r.start_time AND e.ts < r.end_time AND e.event_id % 20 >= 8),
rpct AS (SELECT test_name, avg(value) AS avg_latency,
                max(CASE WHEN rn = floor(n * 0.5::DOUBLE) + 1 THEN value END) AS p50,
                max(CASE WHEN rn = floor(n * 0.95::DOUBLE) + 1 THEN value END) AS p95,
                max(CASE WHEN rn = floor(n * 0.99::DOUBLE) + 1 THEN value END) AS p99
         FROM rlat GROUP BY 1),
rs AS (SELECT r.test_name, r.start_time, r.end_time,
              CAST(coalesce(m.sent, 0) AS BIGINT) AS messages_sent,
              CAST(coalesce(m.processed, 0) AS BIGINT) AS messages_processed,
              coalesce(p.avg_latency, 0.0) AS avg_latency,
              coalesce(p.p50, 0.0) AS p50_latency, coalesce(p.p95, 0.0) AS p95_latency,
              coalesce(p.p99, 0.0) AS p99_latency,
              CAST(coalesce(m.errors, 0) AS BIGINT) AS errors,
              coalesce(m.processed, 0) / 3600.0 AS throughput
       FROM runs r LEFT JOIN rmsg m USING (test_name) LEFT JOIN rpct p USING (test_name))"""


# The same with the latency of all events.
RUNS_ALL = RUNS.replace(" AND e.event_id % 20 >= 8", "")


def wr(body: str, runs: str = RUNS) -> str:
    return "WITH " + EV.strip() + ",\n" + runs.strip() + "\n" + body


ORACLE["run_summary"] = wr("""
SELECT test_name, start_time, end_time, messages_sent, messages_processed, round(avg_latency, 9) AS avg_latency,
       p50_latency, p95_latency, p99_latency, errors, round(throughput, 9) AS throughput FROM rs""", RUNS_ALL)

ORACLE["run_results_loaded"] = wr("""
SELECT test_name, start_time, messages_sent, errors, round(avg_latency, 9) AS avg_latency, p99_latency FROM rs""")

ORACLE["run_analysis"] = wr("""
SELECT count(*) AS total_tests, CAST(sum(messages_sent) AS BIGINT) AS total_messages_sent,
       CAST(sum(messages_processed) AS BIGINT) AS total_messages_processed,
       CAST(sum(errors) AS BIGINT) AS total_errors,
       round(avg(throughput), 9) AS avg_throughput, round(max(throughput), 9) AS max_throughput,
       round(avg(avg_latency), 9) AS avg_latency,
       round(CASE WHEN sum(messages_sent) > 0 THEN sum(messages_processed) / sum(messages_sent) * 100
                  ELSE 0.0 END, 9) AS processing_efficiency,
       round(stddev_pop(throughput), 9) AS throughput_std,
       round(CASE WHEN avg(throughput) > 0 THEN stddev_pop(throughput) / avg(throughput) ELSE 0.0 END, 9)
         AS throughput_cv
FROM rs""", RUNS_ALL)

ORACLE["run_correlation"] = wr("""
SELECT round(covar_pop(throughput, avg_latency)
             / nullif(stddev_pop(throughput) * stddev_pop(avg_latency), 0), 9) AS correlation FROM rs""", RUNS_ALL)

ORACLE["high_error_runs"] = wr("SELECT test_name FROM rs WHERE errors > 0")

ORACLE["high_latency_runs"] = wr("""
SELECT test_name FROM rs
WHERE avg_latency > (SELECT avg(avg_latency) + stddev_pop(avg_latency) FROM rs)""", RUNS_ALL)

ORACLE["latency_long"] = wr("""
SELECT test_name, 'P50' AS percentile, p50_latency AS latency FROM rs
UNION ALL SELECT test_name, 'P95', p95_latency FROM rs
UNION ALL SELECT test_name, 'P99', p99_latency FROM rs""", RUNS_ALL)

ORACLE["efficiency_long"] = wr("""
SELECT test_name, 'Sent' AS kind, messages_sent AS count FROM rs
UNION ALL SELECT test_name, 'Processed', messages_processed FROM rs""")

ORACLE["throughput_errors"] = wr("SELECT test_name, round(throughput, 9) AS throughput, errors FROM rs")

_ERR_B60 = (f"SELECT {BASE_SERIES} AS series, {bucket('publish_time', 60)} AS bucket, "
            "avg(CASE WHEN reject_reason IS NOT NULL THEN 1.0 ELSE 0.0 END) AS value FROM cls GROUP BY 1, 2")

ORACLE["alerts_config_rules"] = alert_sql([
    islands("lat", "processing_latency", _lat_b(60), ">", 5.0, 300, 60),
    islands("er", "error_rate", _ERR_B60, ">", 0.01, 300, 60),
    islands("lt", "low_throughput", _pts_b("counter/messages_processed", "sum", 60), "<", 100.0, 300, 60,
            fill=True),
])

ORACLE["metric_catalog_usage"] = wm("""
SELECT c.name, c.declared_kind, c.description, coalesce(p.n, 0) AS n_points
FROM cat c LEFT JOIN (
  SELECT regexp_extract(metric_type, '^[^/]+/(.*)$', 1) AS name, count(*) AS n
  FROM (SELECT metric_type FROM pts UNION ALL SELECT 'latency/processing_latency' FROM xp)
  GROUP BY 1) p USING (name)""", ctes="""
cat AS (SELECT * FROM (VALUES
  """ + ",\n  ".join(f"('{name}', '{kind}', '{told}')" for name, kind, told in CATALOG) + """) AS t(name, declared_kind, description))""")
