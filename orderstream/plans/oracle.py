"""DuckDB SQL twins of the registered queries (tables pre-registered as views).

Conventions: money sums are DECIMAL(18,2) cast back to DOUBLE, counts are
BIGINT, event time is integer epoch ms (``epoch_us(ts) // 1000`` truncates
exactly like Spark's ``unix_millis``), timestamps leave as naive TIMESTAMP.
"""

from __future__ import annotations

from orderstream.functions.metric_names import EXPORTER_RULES
from orderstream.operators.alerts import DEFAULT_RULES
from orderstream.operators.loadtest import PROFILES
from orderstream.plans import catalog as C
from orderstream.plans import fixtures as FX

NL = "chr(10)"


def _ms(ts_sql: str) -> str:
    return f"epoch_us({ts_sql}) // 1000"


def _oe(dense: bool = False) -> str:
    ts = _ms("ts")
    if dense:
        ts = f"{FX.EPOCH0_MS} + ({_ms('ts')} - {FX.EPOCH0_MS}) // {FX.DENSE_FACTOR}"
    return f"""SELECT event_id,
  CASE WHEN event_id % 150 = 100 THEN '' ELSE 'ord-' || CAST(event_id AS VARCHAR) END AS order_id,
  CASE WHEN event_id % 150 = 50 THEN '' ELSE 'user-' || CAST(user_id AS VARCHAR) END AS user_id,
  CASE WHEN event_id % 150 = 0 THEN -1.0 - value ELSE value END AS amount,
  CASE WHEN event_id % 50 = 0 THEN 'PLACED'
       WHEN event_type IN ('purchase','signup') THEN 'PLACED'
       WHEN event_type IN ('view','click') THEN 'SHIPPED' ELSE 'CANCELLED' END AS status,
  {ts} AS timestamp, value, event_type
FROM events"""


POISON = "(amount < 0 OR user_id IS NULL OR user_id = '' OR order_id IS NULL OR order_id = '')"
REASON = """CASE WHEN amount < 0 THEN 'NEGATIVE_AMOUNT'
  WHEN user_id IS NULL OR user_id = '' THEN 'MISSING_USER_ID'
  WHEN order_id IS NULL OR order_id = '' THEN 'MISSING_ORDER_ID' END"""
MONEY = "CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


def _ts(ms_sql: str) -> str:
    return f"make_timestamp(({ms_sql}) * 1000)"


def _stats(src_cte: str, width_ms: int = 60000) -> str:
    return f"""SELECT user_id, COUNT(*) AS order_count, {MONEY.format(c='amount')} AS total_amount,
  {_ts(f'timestamp - timestamp % {width_ms}')} AS window_start,
  {_ts(f'timestamp - timestamp % {width_ms} + {width_ms}')} AS window_end
FROM {src_cte} WHERE status = 'PLACED' AND NOT {POISON}
GROUP BY user_id, timestamp - timestamp % {width_ms}"""


STATS_CTE = f"WITH oe AS ({_oe(True)}), stats AS ({_stats('oe')})\n"

TOP_USERS = f"""SELECT user_id, CAST(SUM(order_count) AS BIGINT) AS order_count,
  {MONEY.format(c='total_amount')} AS total_amount
FROM stats GROUP BY user_id ORDER BY total_amount DESC, user_id LIMIT {C.TOP_N}"""


def _kpi(src: str) -> str:
    return f"""SELECT COALESCE(revenue, 0.0) AS revenue, orders,
  CASE WHEN orders > 0 THEN CAST(COALESCE(revenue, 0.0) AS DOUBLE) / CAST(orders AS DOUBLE) ELSE 0.0 END AS avg_order_value
FROM (SELECT {MONEY.format(c='total_amount')} AS revenue,
             CAST(COALESCE(SUM(order_count), 0) AS BIGINT) AS orders FROM {src})"""


def _latest(measure_sql: str, name: str) -> str:
    return f"""SELECT * FROM (SELECT window_start, {measure_sql} AS {name} FROM stats
  GROUP BY window_start ORDER BY window_start DESC LIMIT {C.LATEST_WINDOWS}) ORDER BY window_start"""


JSON_MAL = "(event_id % 1000 IN (999, 500))"
JS = """'{"order_id":"' || order_id || '","user_id":"' || user_id || '","amount":' || CAST(amount AS VARCHAR)
  || ',"status":"' || status || '","timestamp":' || CAST(timestamp AS VARCHAR) || '}'"""

DLQ_RECORDS = f"""dr AS (SELECT *, event_id AS "offset", CAST(event_id // 50 % 3 AS INTEGER) AS "partition",
  CASE WHEN event_id % 4 = 2 THEN 0 WHEN event_id % 1100 = 50 THEN -3 WHEN event_id % 1300 = 100 THEN 4000000000000
       ELSE event_id // 50 % 7 END AS retry_count,
  event_id % 900 = 0 AS undecodable
  FROM oe WHERE {POISON})"""

PLAN = """SELECT *, CASE WHEN retry_count >= 5 THEN 'PERMANENT' ELSE 'RETRY' END AS decision,
  CASE WHEN retry_count < 5 THEN CAST(1000 * (CAST(1 AS BIGINT) << CAST(greatest(retry_count, 0) AS INTEGER)) AS BIGINT) END AS backoff_ms,
  CASE WHEN retry_count < 5 THEN retry_count + 1 END AS next_retry_count
FROM dr"""

MESSAGES_IN = FX.MESSAGES_IN


def _gauges() -> str:
    """The samples of the rules that the events themselves don't feed, written out."""
    rows = [
        ("kafka_server_replica_manager_under_replicated_partitions", "kafka-2", "CASE WHEN k % 40 < 8 THEN 2.0 ELSE 0.0 END"),
        ("kafka_controller_offline_partitions_count", "kafka-1", "CASE WHEN k % 60 < 3 THEN 1.0 ELSE 0.0 END"),
        ("kafka_controller_active_controller_count", "kafka-1", "CASE WHEN k % 50 < 6 THEN 0.0 ELSE 1.0 END"),
        ("flink_jobmanager_job_lastCheckpointDuration", "flink-1", "CASE WHEN k % 45 < 25 THEN 70000.0 ELSE 5000.0 END"),
        ("flink_jobmanager_job_uptime", "flink-1", "CASE WHEN k % 80 < 12 THEN 0.0 ELSE 60000.0 END"),
        ("flink_jobmanager_job_numberOfFailedCheckpoints", "flink-1", "k // 30"),
    ]
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST(NULL AS VARCHAR) AS topic, '{i}' AS instance, {_ts('bucket_ms')} AS ts, "
                              f"CAST({v} AS DOUBLE) AS value FROM buckets" for m, i, v in rows)


SAMPLES_CTE = f"""WITH oe AS ({_oe(True)}),
base AS (SELECT CASE WHEN {POISON} THEN 'order-events-dlq' ELSE 'order-events' END AS topic,
  'kafka-' || CAST(event_id % 3 + 1 AS VARCHAR) AS instance, timestamp - timestamp % {FX.SCRAPE_MS} AS bucket_ms, value
  FROM oe),
counts AS (SELECT topic, instance, bucket_ms, COUNT(*) AS n FROM base GROUP BY topic, instance, bucket_ms),
counter AS (SELECT '{MESSAGES_IN}' AS metric, topic, instance, {_ts('bucket_ms')} AS ts,
  CAST(SUM(n) OVER (PARTITION BY topic, instance, (instance = 'kafka-2' AND bucket_ms >= {FX.COUNTER_RESET_MS})
        ORDER BY bucket_ms ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS value FROM counts),
gauge AS (SELECT '{FX.PRODUCE_P99}' AS metric, CAST(NULL AS VARCHAR) AS topic, instance, {_ts('bucket_ms')} AS ts,
  MAX(value) / CAST(20 AS DOUBLE) AS value FROM base GROUP BY instance, bucket_ms),
buckets AS (SELECT DISTINCT bucket_ms, (bucket_ms - {FX.EPOCH0_MS}) // {FX.SCRAPE_MS} AS k FROM base),
rest AS ({_gauges()}),
samples AS (SELECT * FROM counter UNION ALL SELECT * FROM gauge UNION ALL SELECT * FROM rest)
"""


def _epoch(ts_text: str) -> int:
    import datetime as dt
    d = dt.datetime.fromisoformat(ts_text).replace(tzinfo=dt.timezone.utc)
    return int(d.timestamp() * 1000)


def _deltas(src: str) -> str:
    return f"""SELECT *, {_ms('ts')} AS ms,
  CASE WHEN LAG(value) OVER (PARTITION BY metric, topic, instance ORDER BY ts) IS NULL THEN 0.0
       WHEN value < LAG(value) OVER (PARTITION BY metric, topic, instance ORDER BY ts) THEN value
       ELSE value - LAG(value) OVER (PARTITION BY metric, topic, instance ORDER BY ts) END AS delta
FROM {src}"""


def _increase(src: str, range_s: int = 300) -> str:
    w = f"(PARTITION BY metric, topic, instance ORDER BY ms RANGE BETWEEN {range_s * 1000 - 1} PRECEDING AND CURRENT ROW)"
    return f"""SELECT metric, topic, instance, ts, value,
  SUM(delta) OVER {w} - FIRST_VALUE(delta) OVER {w} AS increase
FROM ({_deltas(src)})"""


def _bounded(src: str, range_s: int, start: str, end: str) -> str:
    return f"(SELECT * FROM {src} WHERE ts <= TIMESTAMP '{end}' AND {_ms('ts')} > {_epoch(start) - range_s * 1000})"


def _sum_rate_range(src: str, start: str, end: str, step_s: int = 15, range_s: int = 300) -> str:
    """sum(rate(x[range])) straight from its definition: at each step, for each series
    the growth between the samples inside the window, over all series."""
    s_ms, steps = _epoch(start), (_epoch(end) - _epoch(start)) // (step_s * 1000)
    return f"""SELECT metric, {_ts(f'{s_ms} + k * {step_s * 1000}')} AS ts, SUM(growth) / CAST({range_s} AS DOUBLE) AS value FROM (
  SELECT metric, topic, instance, k, SUM(delta) - arg_min(delta, ms) AS growth
  FROM ({_deltas(src)}) d, (SELECT unnest(generate_series(0, {steps})) AS k) g
  WHERE ms <= {s_ms} + k * {step_s * 1000} AND ms > {s_ms} + k * {step_s * 1000} - {range_s * 1000}
  GROUP BY metric, topic, instance, k HAVING COUNT(*) >= 2)
GROUP BY metric, k"""


def _range(src: str, start: str, end: str, step_s: int = 15, lookback_s: int = 300) -> str:
    s_ms, e_ms, step, lb = _epoch(start), _epoch(end), step_s * 1000, lookback_s * 1000
    return f"""SELECT metric, topic, instance, {_ts(f'{s_ms} + k * {step}')} AS ts, value FROM (
  SELECT metric, topic, instance, value,
    GREATEST(CAST(ceil((ms - {s_ms}) / CAST({step} AS DOUBLE)) AS BIGINT), 0) AS k_lo,
    CAST(floor((LEAST(COALESCE(next_ms - 1, 4611686018427387904), ms + {lb} - 1, {e_ms}) - {s_ms}) / CAST({step} AS DOUBLE)) AS BIGINT) AS k_hi
  FROM (SELECT *, LEAD(ms) OVER (PARTITION BY metric, topic, instance ORDER BY ms) AS next_ms
        FROM (SELECT metric, topic, instance, value, {_ms('ts')} AS ms FROM {src}
              WHERE ts <= TIMESTAMP '{end}' AND {_ms('ts')} > {s_ms - lb}))
) g, LATERAL (SELECT unnest(generate_series(k_lo, k_hi)) AS k) WHERE k_lo <= k_hi"""


def _sql_str(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _rules_values() -> str:
    rows = []
    for r in DEFAULT_RULES:
        rows.append("(" + ", ".join([
            _sql_str(r.alert), _sql_str(r.metric), _sql_str(r.op), f"CAST({float(r.threshold)!r} AS DOUBLE)",
            str(r.for_s), _sql_str(r.severity), _sql_str(r.summary), _sql_str(r.func),
            "CAST(NULL AS INTEGER)" if r.range_s is None else f"CAST({r.range_s} AS INTEGER)",
            "CAST(NULL AS VARCHAR)" if r.topic is None else _sql_str(r.topic)]) + ")")
    return ("SELECT * FROM (VALUES " + ", ".join(rows) +
            ") AS r(alert, metric, op, threshold, for_s, severity, summary, func, range_s, topic)")


def _timeline(since: str = C.ALERT_SINCE, at: str = C.ALERT_AT) -> str:
    funcs = sorted({(r.func, r.range_s) for r in DEFAULT_RULES}, key=str)
    parts = []
    for func, rng in funcs:
        metrics = ", ".join(sorted({_sql_str(r.metric) for r in DEFAULT_RULES if r.func == func and r.range_s == rng}))
        src = _bounded(f"(SELECT * FROM samples WHERE metric IN ({metrics}))", 300, since, at)
        rs = "CAST(NULL AS INTEGER)" if rng is None else f"CAST({rng} AS INTEGER)"
        if func == "value":
            parts.append(f"SELECT metric, topic, instance, ts, value AS expr_value, 'value' AS func, {rs} AS range_s FROM {src}")
        elif func == "increase":
            parts.append(f"SELECT metric, topic, instance, ts, increase AS expr_value, 'increase' AS func, {rs} AS range_s FROM ({_increase(src, rng)})")
        else:
            parts.append(f"SELECT metric, topic, instance, ts, increase / CAST({rng} AS DOUBLE) AS expr_value, 'rate' AS func, {rs} AS range_s FROM ({_increase(src, rng)})")
    x = " UNION ALL ".join(parts)
    w = "(PARTITION BY alert, metric, topic, instance ORDER BY ms)"
    return SAMPLES_CTE + f""", x AS ({x}),
rules AS ({_rules_values()}),
j AS (SELECT x.metric, x.topic, x.instance, x.ts, x.expr_value, r.alert, r.op, r.threshold, r.for_s, r.severity, r.summary
      FROM x JOIN rules r ON x.metric = r.metric AND x.func = r.func AND x.range_s IS NOT DISTINCT FROM r.range_s
       AND (r.topic IS NULL OR x.topic = r.topic)
      WHERE x.ts >= TIMESTAMP '{since}'),
c AS (SELECT *, {_ms('ts')} AS ms,
  COALESCE(CASE WHEN op = '>' THEN expr_value > threshold WHEN op = '==' THEN expr_value = threshold ELSE false END, false) AS cond
  FROM j),
s AS (SELECT *, CASE WHEN cond AND (LAG(cond) OVER {w} IS NULL OR NOT LAG(cond) OVER {w}
                                    OR ms - LAG(ms) OVER {w} > 300000) THEN ms END AS start_ms FROM c),
i AS (SELECT *, MAX(start_ms) OVER (PARTITION BY alert, metric, topic, instance ORDER BY ms
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island_ms FROM s),
tl AS (SELECT alert, metric, topic, instance, ts, expr_value AS value,
  CASE WHEN NOT cond THEN 'inactive' WHEN ms - island_ms >= for_s * 1000 THEN 'firing' ELSE 'pending' END AS state,
  CASE WHEN cond THEN {_ts('island_ms')} END AS active_at, severity, summary FROM i),
tl2 AS (SELECT alert, metric, topic, instance, ts, value, state, active_at,
  COALESCE(severity, CASE WHEN state = 'firing' THEN 'warning' ELSE 'info' END) AS severity, summary FROM tl)
"""


STATES = _timeline() + f""", st AS (SELECT alert, metric, topic, instance, ts, value, state, active_at, severity, summary
  FROM (SELECT *, row_number() OVER (PARTITION BY alert, metric, topic, instance ORDER BY ts DESC) AS rn FROM tl2)
  WHERE rn = 1 AND {_ms('ts')} > {_epoch(C.ALERT_AT) - 300000})
"""


def _jmx() -> str:
    topics = "[" + ", ".join(_sql_str(t) for t in FX.JMX_TOPICS) + "]"
    cases = []
    for i, (tmpl, has_topic) in enumerate(FX.JMX_BEANS):
        if has_topic:
            pre, post = tmpl.split("{t}")
            cases.append(f"WHEN {i} THEN {_sql_str(pre)} || {topics}[user_id % 3 + 1] || {_sql_str(post)}")
        else:
            cases.append(f"WHEN {i} THEN {_sql_str(tmpl)}")
    bean = f"CASE event_id % {len(FX.JMX_BEANS)} " + " ".join(cases) + " END"
    bean = f"CASE WHEN event_id % 5 = 1 THEN 'jmx ' ELSE '' END || {bean} || CASE WHEN event_id % 7 = 2 THEN ': 1.5' ELSE '' END"
    name = "CASE " + " ".join(f"WHEN regexp_matches(mbean, {_sql_str(p)}) THEN {_sql_str(n)}"
                              for p, n, _ in EXPORTER_RULES) + " END"
    topic = "CASE " + " ".join(
        f"WHEN regexp_matches(mbean, {_sql_str(p)}) THEN "
        + (f"regexp_extract(mbean, {_sql_str(p)}, 1)" if t else "CAST(NULL AS VARCHAR)")
        for p, _, t in EXPORTER_RULES) + " END"
    return f"""SELECT * FROM (SELECT event_id, lower({name}) AS metric, {topic} AS topic, value
FROM (SELECT event_id, {bean} AS mbean, value FROM events)) WHERE metric IS NOT NULL"""


SEND_LOG = f"""WITH oe AS ({_oe(True)}),
sl AS (SELECT timestamp AS ms, event_type AS request, 100 AS batch_size, value AS duration_ms,
  event_type = 'error' AS error FROM oe)
"""

SUMMARY = """SELECT CAST(COALESCE(SUM(CASE WHEN NOT error THEN batch_size END), 0) AS BIGINT) AS total_messages,
  (MAX(ms) - MIN(ms)) / CAST(1000.0 AS DOUBLE) AS duration_s,
  quantile_cont(duration_ms, 0.5) FILTER (WHERE NOT error) AS p50_ms,
  quantile_cont(duration_ms, 0.95) FILTER (WHERE NOT error) AS p95_ms,
  quantile_cont(duration_ms, 0.99) FILTER (WHERE NOT error) AS p99_ms,
  CAST(COUNT(*) FILTER (WHERE error) AS DOUBLE) * CAST(100.0 AS DOUBLE) / COUNT(*) AS error_rate_pct
FROM sl"""


def _profiles_values() -> str:
    rows = ", ".join(f"({_sql_str(p)}, CAST({e!r} AS DOUBLE), CAST({l!r} AS DOUBLE))" for p, e, l in PROFILES)
    return f"(VALUES {rows}) AS p(profile, max_error_rate_pct, max_p99_ms)"


def _perm_text() -> str:
    return (f"printf(':red_circle: *DLQ Permanent Failure*' || {NL} || 'Order `%s` by user `%s` failed after %d retries'"
            f" || {NL} || 'Amount: $%.2f | Status: %s', order_id, user_id, retry_count, amount, status)")


def _dlq_text() -> str:
    o = "CASE WHEN undecodable THEN 'unknown' ELSE order_id END"
    u = "CASE WHEN undecodable THEN 'unknown' ELSE user_id END"
    a = "CASE WHEN undecodable THEN 'unknown' ELSE CAST(amount AS VARCHAR) END"
    return (f"':red_circle: *DLQ Alert*' || {NL} || 'Order `' || {o} || '` by user `' || {u} || "
            f"'` routed to dead letter queue' || {NL} || 'Amount: $' || {a} || ' | Topic: `order-events-dlq` | Partition: '"
            f" || CAST(\"partition\" AS VARCHAR)")


SQL = {
    "validate_events": f"""WITH oe AS ({_oe()})
SELECT event_id, order_id, user_id, amount, status, timestamp, {_ts('timestamp')} AS event_time, {REASON} AS dlq_reason
FROM oe""",
    "decode_validate": f"""WITH oe AS ({_oe()})
SELECT event_id,
  CASE WHEN {JSON_MAL} THEN NULL ELSE order_id END AS order_id,
  CASE WHEN {JSON_MAL} THEN NULL ELSE user_id END AS user_id,
  CASE WHEN {JSON_MAL} THEN 0.0 ELSE amount END AS amount,
  CASE WHEN {JSON_MAL} THEN NULL ELSE status END AS status,
  CASE WHEN {JSON_MAL} THEN 0 ELSE timestamp END AS timestamp,
  {_ts(f'CASE WHEN {JSON_MAL} THEN 0 ELSE timestamp END')} AS event_time,
  CASE WHEN {JSON_MAL} THEN 'MALFORMED_JSON' ELSE {REASON} END AS dlq_reason
FROM oe""",
    "valid_events": f"WITH oe AS ({_oe()}) SELECT event_id, order_id, user_id, amount, status, timestamp FROM oe WHERE NOT {POISON}",
    "dlq_events": f"""WITH oe AS ({_oe()}) SELECT event_id, order_id, user_id, amount, status, timestamp, {REASON} AS dlq_reason
FROM oe WHERE {POISON}""",
    "dlq_payload": f"""WITH oe AS ({_oe()}) SELECT event_id, user_id AS record_key,
  '{{"order_id":"' || order_id || '","user_id":"' || user_id || '","amount":' || CAST(amount AS VARCHAR)
  || ',"status":"' || status || '","timestamp":' || CAST(timestamp AS VARCHAR) || '}}' AS record_value
FROM oe WHERE {POISON}""",
    "dlq_rate": f"""WITH oe AS ({_oe()}), t AS (SELECT CASE WHEN {JSON_MAL} THEN 'MALFORMED_JSON' ELSE {REASON} END AS r FROM oe)
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE r IS NULL) AS valid, COUNT(*) FILTER (WHERE r IS NOT NULL) AS dlq,
  COUNT(*) FILTER (WHERE r = 'NEGATIVE_AMOUNT') AS negative_amount, COUNT(*) FILTER (WHERE r = 'MISSING_USER_ID') AS missing_user_id,
  COUNT(*) FILTER (WHERE r = 'MISSING_ORDER_ID') AS missing_order_id, COUNT(*) FILTER (WHERE r = 'MALFORMED_JSON') AS malformed_json,
  CASE WHEN COUNT(*) > 0 THEN CAST(COUNT(*) FILTER (WHERE r IS NOT NULL) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) ELSE 0.0 END AS dlq_share
FROM t""",
    "dlq_rate_by_window": f"""WITH oe AS ({_oe(True)}), t AS (SELECT timestamp - timestamp % 300000 AS w, {REASON} AS r FROM oe)
SELECT {_ts('w')} AS window_start, COUNT(*) AS total, COUNT(*) FILTER (WHERE r IS NULL) AS valid,
  COUNT(*) FILTER (WHERE r IS NOT NULL) AS dlq,
  COUNT(*) FILTER (WHERE r = 'NEGATIVE_AMOUNT') AS negative_amount, COUNT(*) FILTER (WHERE r = 'MISSING_USER_ID') AS missing_user_id,
  COUNT(*) FILTER (WHERE r = 'MISSING_ORDER_ID') AS missing_order_id, COUNT(*) FILTER (WHERE r = 'MALFORMED_JSON') AS malformed_json,
  CASE WHEN COUNT(*) > 0 THEN CAST(COUNT(*) FILTER (WHERE r IS NOT NULL) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) ELSE 0.0 END AS dlq_share
FROM t GROUP BY w""",
    "partitioned_by_user": f"WITH oe AS ({_oe()}) SELECT user_id, order_id, amount, status, timestamp FROM oe WHERE NOT {POISON}",
    "order_stats_1m": STATS_CTE + "SELECT * FROM stats",
    "orders_daily_stats": f"""WITH o AS (SELECT 'ord-' || CAST(o_orderkey AS VARCHAR) AS order_id, 'user-' || CAST(o_custkey AS VARCHAR) AS user_id,
  o_totalprice AS amount, CASE o_orderstatus WHEN 'O' THEN 'PLACED' WHEN 'F' THEN 'SHIPPED' WHEN 'P' THEN 'CANCELLED' END AS status,
  {_ms('o_orderdate')} AS timestamp FROM orders)
{_stats('o', 86400000)}""",
    "top_users": STATS_CTE + TOP_USERS,
    "revenue_over_time": STATS_CTE + _latest(MONEY.format(c="total_amount"), "total_amount"),
    "volume_over_time": STATS_CTE + _latest("CAST(SUM(order_count) AS BIGINT)", "order_count"),
    "kpi_top20": STATS_CTE + f", t AS ({TOP_USERS})\n" + _kpi("t"),
    "kpi_global": STATS_CTE + f", t AS (SELECT user_id, CAST(SUM(order_count) AS BIGINT) AS order_count, {MONEY.format(c='total_amount')} AS total_amount FROM stats GROUP BY user_id)\n" + _kpi("t"),
    "upsert_latest": f"""WITH oe AS ({_oe(True)}),
b AS ({_stats("(SELECT * FROM oe WHERE event_id % 2 = 0)")}),
f AS ({_stats("oe")}),
log AS (SELECT *, 0 AS batch_id FROM b UNION ALL SELECT *, 1 AS batch_id FROM f)
SELECT user_id, arg_max(order_count, batch_id) AS order_count, arg_max(total_amount, batch_id) AS total_amount,
  window_start, arg_min(window_end, batch_id) AS window_end
FROM log GROUP BY user_id, window_start""",
    "dedup_orders": f"""WITH oe AS ({_oe()}), d AS (SELECT * FROM oe UNION ALL SELECT * FROM oe WHERE event_id % 97 = 0)
SELECT event_id, order_id, user_id, amount, status, timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY timestamp, event_id) AS rn FROM d WHERE NOT {POISON})
WHERE rn = 1""",
    "retry_plan": f"""WITH oe AS ({_oe()}), {DLQ_RECORDS}, p AS ({PLAN})
SELECT "offset", "partition", order_id, user_id, amount, status, retry_count, decision, backoff_ms, next_retry_count,
  CASE WHEN retry_count < 5 THEN {_ts('timestamp + backoff_ms')} END AS next_attempt_at
FROM p WHERE NOT undecodable""",
    "retry_outcomes": f"""WITH oe AS ({_oe()}), {DLQ_RECORDS}, p AS ({PLAN})
SELECT CASE WHEN undecodable THEN 'REJECTED' ELSE decision END AS decision, COUNT(*) AS records FROM p GROUP BY 1""",
    "retry_permanent_alerts": f"""WITH oe AS ({_oe()}), {DLQ_RECORDS}
SELECT "offset", {_perm_text()} AS alert_text FROM dr WHERE NOT undecodable AND retry_count >= 5""",
    "dlq_alert_text": f"""WITH oe AS ({_oe()}), {DLQ_RECORDS}
SELECT "offset", {_dlq_text()} AS alert_text FROM dr""",
    "dlq_roundtrip": f"""WITH oe AS ({_oe()}), j AS (SELECT *, {JSON_MAL} AS mal,
  '{{"order_id":"' || order_id || '","user_id":"' || user_id || '","amount":' || CAST(amount AS VARCHAR)
  || ',"status":"' || status || '","timestamp":' || CAST(timestamp AS VARCHAR) || '}}' AS js FROM oe)
SELECT event_id, CASE WHEN mal THEN 'MALFORMED_JSON' ELSE {REASON} END AS reason,
  CAST(CASE WHEN mal THEN 0 ELSE 5 END AS BIGINT) AS attempts, CASE WHEN mal THEN 'REJECTED' ELSE 'PERMANENT' END AS outcome,
  hex(CASE WHEN event_id % 1000 = 500 THEN '' WHEN event_id % 1000 = 999 THEN substr(js, 1, 25) ELSE js END) AS value_hex
FROM j WHERE mal OR {POISON}""",
    "metric_latest": SAMPLES_CTE + f"""SELECT metric, topic, instance, max(ts) AS ts, arg_max(value, ts) AS value FROM samples
WHERE ts <= TIMESTAMP '{C.INSTANT_AT}' AND {_ms('ts')} > {_epoch(C.INSTANT_AT) - 300000}
GROUP BY metric, topic, instance""",
    "metric_range": SAMPLES_CTE + _range("samples", C.RANGE_START, C.RANGE_END),
    "metric_sum": SAMPLES_CTE + f"""SELECT metric, ts, SUM(value) AS value FROM ({_range(
        f"(SELECT * FROM samples WHERE metric = '{MESSAGES_IN}' AND topic = 'order-events')", C.RANGE_START, C.RANGE_END)})
GROUP BY metric, ts""",
    "per_instance_latest": SAMPLES_CTE + f""", mine AS (SELECT * FROM samples WHERE metric = '{MESSAGES_IN}' AND topic = 'order-events'),
shown AS (SELECT instance, ts, value FROM mine WHERE NOT (instance = 'kafka-3' AND {_ms('ts')} > {_epoch(C.INSTANT_AT) - 360000})
  UNION ALL SELECT NULL, ts, value + 1000 FROM mine WHERE instance = 'kafka-2'
  UNION ALL SELECT '', ts - INTERVAL 15 SECOND, value + 2000 FROM mine WHERE instance = 'kafka-2'),
alive AS (SELECT * FROM shown WHERE ts <= TIMESTAMP '{C.INSTANT_AT}' AND {_ms('ts')} > {_epoch(C.INSTANT_AT) - 300000})
SELECT CASE WHEN instance = '' OR instance IS NULL THEN 'unknown' ELSE instance END AS instance, ts, value FROM alive
QUALIFY row_number() OVER (PARTITION BY CASE WHEN instance = '' OR instance IS NULL THEN 'unknown' ELSE instance END
                           ORDER BY ts DESC, instance NULLS FIRST) = 1""",
    "metric_rate_5m": SAMPLES_CTE + f"""SELECT metric, topic, instance, ts, increase / CAST(300 AS DOUBLE) AS value
FROM ({_increase(_bounded(f"(SELECT * FROM samples WHERE metric = '{MESSAGES_IN}')", 300, C.RANGE_START, C.RANGE_END))})
WHERE ts >= TIMESTAMP '{C.RANGE_START}'""",
    "metric_increase_5m": SAMPLES_CTE + f"""SELECT metric, topic, instance, ts, increase AS value
FROM ({_increase(_bounded(f"(SELECT * FROM samples WHERE metric = '{MESSAGES_IN}')", 300, C.RANGE_START, C.RANGE_END))})
WHERE ts >= TIMESTAMP '{C.RANGE_START}'""",
    "dlq_rate_sum_range": SAMPLES_CTE + _sum_rate_range(
        f"(SELECT * FROM samples WHERE metric = '{MESSAGES_IN}' AND topic = 'order-events-dlq')", C.RANGE_START, C.RANGE_END),
    "alert_timeline": _timeline() + "SELECT * FROM tl2",
    "alert_states": STATES + "SELECT * FROM st",
    "active_alerts": STATES + """SELECT * FROM st WHERE state IN ('firing', 'pending')
  AND alert IN ('DLQEventsDetected', 'DLQHighRate', 'KafkaHighProducerLatency')""",
    "alert_state_counts": STATES + """SELECT COUNT(*) FILTER (WHERE state = 'firing') AS firing,
  COUNT(*) FILTER (WHERE state = 'pending') AS pending, COUNT(*) FILTER (WHERE state = 'inactive') AS inactive FROM st""",
    "status_bands": SAMPLES_CTE + f"""SELECT metric, instance, ts, value,
  CASE WHEN value >= 10 THEN 'critical' WHEN value >= 6 THEN 'warning' ELSE 'ok' END AS band
FROM samples WHERE metric = '{FX.PRODUCE_P99}'
UNION ALL
SELECT metric, CAST(NULL AS VARCHAR) AS instance, ts, value, CASE WHEN value >= 5 THEN 'critical' WHEN value >= 1 THEN 'warning' ELSE 'ok' END AS band
FROM ({_sum_rate_range(f"(SELECT * FROM samples WHERE metric = '{MESSAGES_IN}' AND topic = 'order-events-dlq')", C.RANGE_START, C.RANGE_END)})""",
    "metric_names_parsed": _jmx(),
    "stream_order_stats": f"WITH oe AS ({_oe(True)}), ok AS (SELECT * FROM oe WHERE NOT {JSON_MAL})\n" + _stats("ok"),
    "stream_retry_release": f"""WITH oe AS ({_oe()}), {DLQ_RECORDS}
SELECT "offset", order_id, user_id, CASE WHEN retry_count >= 5 THEN retry_count ELSE retry_count + 1 END AS retry_count,
  CASE WHEN retry_count >= 5 THEN 'PERMANENT' ELSE 'RETRY' END AS decision
FROM dr WHERE NOT undecodable""",
    "stream_retry_continuous": f"""WITH oe AS ({_oe()}), {DLQ_RECORDS}
SELECT "partition", "offset", CASE WHEN retry_count >= 5 THEN 'PERMANENT' ELSE 'RETRY' END AS decision, user_id AS record_key,
  {JS} AS record_value, CASE WHEN retry_count >= 5 THEN retry_count ELSE retry_count + 1 END AS retry_header
FROM dr WHERE NOT undecodable""",
    "stream_dlq_once": f"""WITH oe AS ({_oe()}), j AS (SELECT *, {JSON_MAL} AS mal, {JS} AS js FROM oe)
SELECT 'order-events' AS topic, CAST(event_id % 12 AS INTEGER) AS "partition", event_id AS "offset",
  hex(CASE WHEN event_id % 1000 = 500 THEN '' WHEN event_id % 1000 = 999 THEN substr(js, 1, 25) ELSE js END) AS value_hex,
  CASE WHEN event_id % 7 = 0 THEN event_id % 3 ELSE 0 END AS retry_header, CASE WHEN mal THEN 'MALFORMED_JSON' ELSE {REASON} END AS reason
FROM j WHERE mal OR {POISON}""",
    "stream_split_job": f"""WITH oe AS ({_oe()}), j AS (SELECT *, {JSON_MAL} AS mal FROM oe)
SELECT event_id, CASE WHEN NOT mal THEN order_id END AS order_id, CASE WHEN NOT mal THEN user_id END AS user_id,
  CASE WHEN mal THEN 0.0 ELSE amount END AS amount, CASE WHEN NOT mal THEN status END AS status, CASE WHEN mal THEN 0 ELSE timestamp END AS timestamp,
  CASE WHEN mal THEN 'MALFORMED_JSON' ELSE {REASON} END AS dlq_reason FROM j""",
    "stream_split_watermark": f"WITH oe AS ({_oe(True)}), ok AS (SELECT * FROM oe WHERE NOT {JSON_MAL})\n" + _stats("ok"),
    "stream_dedup_history": f"""WITH oe AS ({_oe()})
SELECT order_id, user_id, amount, status, timestamp FROM oe WHERE NOT {POISON}""",
    "stream_alert_timeline": _timeline("2024-01-01 00:00:00") + f"SELECT * FROM tl2 WHERE ts >= TIMESTAMP '{C.ALERT_SINCE}'",
    "stream_user_medians": f"""WITH oe AS ({_oe(True)})
SELECT user_id, {_ts('timestamp - timestamp % 60000')} AS window_start, {_ts('timestamp - timestamp % 60000 + 60000')} AS window_end,
  quantile_disc(amount, 0.5) AS median_amount, max(amount) - min(amount) AS spread, count(*) AS orders
FROM oe WHERE status = 'PLACED' AND NOT {POISON} AND NOT {JSON_MAL} GROUP BY user_id, timestamp - timestamp % 60000""",
    "maintained_totals": STATS_CTE + f"""SELECT 'user' AS total_of, user_id AS name, CAST(SUM(order_count) AS BIGINT) AS order_count,
  {MONEY.format(c='total_amount')} AS total_amount FROM stats GROUP BY user_id
UNION ALL SELECT 'window', strftime(window_start, '%Y-%m-%d %H:%M:%S'), CAST(SUM(order_count) AS BIGINT), {MONEY.format(c='total_amount')} FROM stats GROUP BY window_start""",
    "stream_dedup_orders": f"""WITH oe AS ({_oe()})
SELECT order_id, user_id, amount, status, timestamp FROM oe WHERE NOT {POISON}""",
    "stream_dlq_archive": f"""WITH oe AS ({_oe()}), j AS (SELECT *, {JSON_MAL} AS mal,
  '{{"order_id":"' || order_id || '","user_id":"' || user_id || '","amount":' || CAST(amount AS VARCHAR)
  || ',"status":"' || status || '","timestamp":' || CAST(timestamp AS VARCHAR) || '}}' AS js FROM oe)
SELECT CASE WHEN event_id % 1000 = 500 THEN '' WHEN event_id % 1000 = 999 THEN substr(js, 1, 25) ELSE js END AS value,
  CASE WHEN mal THEN 'MALFORMED_JSON' ELSE {REASON} END AS dlq_reason
FROM j WHERE mal OR {POISON}""",
    "dlq_notifications": f"""WITH oe AS ({_oe()}), {DLQ_RECORDS}
SELECT "offset", {_dlq_text()} AS alert_text FROM dr""",
    "alert_payloads": f"""WITH oe AS ({_oe()}), {DLQ_RECORDS}
SELECT "offset", '{{"text":"' || replace(replace({_dlq_text()}, '"', '\\"'), {NL}, '\\n') || '"}}' AS payload FROM dr""",
    "parsed_samples": f"""SELECT event_id, CASE WHEN event_id % 10 = 3 THEN NULL ELSE value END AS value,
  make_timestamp(CAST(trunc(CAST({_ms('ts')} AS DOUBLE) / CAST(1000 AS DOUBLE) * CAST(1000000 AS DOUBLE)) AS BIGINT)) AS ts FROM events""",
    "metric_samples": SAMPLES_CTE + "SELECT metric, topic, instance, ts, value FROM samples",
    "load_summary_file": SEND_LOG + f"""SELECT total_messages, duration_s,
  CASE WHEN duration_s > 0 THEN CAST(round(total_messages / duration_s) AS BIGINT) END AS throughput,
  p50_ms, p95_ms, p99_ms, error_rate_pct FROM ({SUMMARY})""",
    "load_summary": SEND_LOG + f"""SELECT total_messages, duration_s,
  CASE WHEN duration_s > 0 THEN CAST(round(total_messages / duration_s) AS BIGINT) END AS throughput,
  p50_ms, p95_ms, p99_ms, error_rate_pct FROM ({SUMMARY})""",
    "latency_percentiles": SEND_LOG + f"""SELECT request, {_ts('ms - ms % 300000')} AS window_start,
  quantile_cont(duration_ms, 0.5) AS p50_ms, quantile_cont(duration_ms, 0.95) AS p95_ms, quantile_cont(duration_ms, 0.99) AS p99_ms,
  {MONEY.format(c='duration_ms')} / COUNT(*) AS mean_ms, COUNT(*) AS samples
FROM sl GROUP BY request, ms - ms % 300000""",
    "load_summary_sketches": SEND_LOG + f"""SELECT total_messages, duration_s,
  CASE WHEN duration_s > 0 THEN CAST(round(total_messages / duration_s) AS BIGINT) END AS throughput, error_rate_pct FROM ({SUMMARY})""",
    "latency_sketches": SEND_LOG + """SELECT request, count(*) AS sends, count(*) FILTER (WHERE error) AS errors,
  CASE WHEN count(*) FILTER (WHERE NOT error) > 0 THEN true END AS p50_ms_near, CASE WHEN count(*) FILTER (WHERE NOT error) > 0 THEN true END AS p95_ms_near,
  CASE WHEN count(*) FILTER (WHERE NOT error) > 0 THEN true END AS p99_ms_near FROM sl GROUP BY request""",
    "slo_check": SEND_LOG + f""", s AS ({SUMMARY})
SELECT p.profile, p.max_error_rate_pct, p.max_p99_ms, s.error_rate_pct, s.p99_ms,
  s.error_rate_pct < p.max_error_rate_pct AS error_ok, s.p99_ms < p.max_p99_ms AS p99_ok,
  (s.error_rate_pct < p.max_error_rate_pct) AND (s.p99_ms < p.max_p99_ms) AS passed
FROM s, {_profiles_values()}""",
}
