"""DuckDB statements that give the same rows as the registered queries."""

_STATUSES = (
    "['INITIATED', 'COMPLIANCE_APPROVED', 'FUNDS_RESERVED', 'RAIL_SETTLED', "
    "'LEDGER_POSTED', 'COMPLETED', 'FAILED', 'REJECTED']"
)
_CURRENCIES = "['USD', 'EUR', 'MXN', 'BRL', 'ARS', 'BTC', 'ETH', 'USDC']"

_PAYMENTS = f"""
numbered AS (
  SELECT event_id, user_id, ts, event_type, event_id // 8 AS pn,
         md5(CAST(event_id // 8 AS VARCHAR)) AS h,
         CAST(round(value * 100) AS BIGINT) * 5000 AS units
  FROM events),
payments AS (
  SELECT event_id,
         substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-'
           || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS payment_id,
         CASE WHEN (pn // 8) % 2 = 0 THEN 'PAY_IN' ELSE 'PAY_OUT' END AS direction,
         'acct-' || user_id AS account,
         {_CURRENCIES}[pn % 8 + 1] AS currency,
         CASE WHEN event_type = 'error' THEN -units ELSE units END AS minor_units,
         {_STATUSES}[(event_id + user_id) % 8 + 1] AS status,
         ts AS occurred_at
  FROM numbered)"""

_ENRICHED = f"""{_PAYMENTS},
enriched AS (
  SELECT *,
         CAST(CASE WHEN abs(minor_units) >= 100000000 THEN 60
                   WHEN abs(minor_units) >= 10000000 THEN 30 ELSE 0 END
              + CASE WHEN direction = 'PAY_OUT' THEN 15 ELSE 0 END AS INTEGER) AS risk_score,
         greatest(0, (epoch_us(TIMESTAMP '2024-01-16 00:00:00') - epoch_us(occurred_at)) // 1000)
           AS ingest_latency_ms,
         TIMESTAMP '2024-01-16 00:00:00' AS processed_at
  FROM payments)"""

_SNAPSHOT = f"""{_ENRICHED},
snapshot AS (
  SELECT 'total' AS dimension, 'all' AS key, count(*) AS n,
         CAST(NULL AS BIGINT) AS settled_minor_units, max(risk_score) AS max_risk_score
  FROM enriched
  UNION ALL
  SELECT 'status', status, count(*), NULL, max(risk_score) FROM enriched GROUP BY status
  UNION ALL
  SELECT 'direction', direction, count(*), NULL, max(risk_score) FROM enriched GROUP BY direction
  UNION ALL
  SELECT 'currency', currency, count(*),
         CAST(sum(minor_units) FILTER (WHERE status = 'COMPLETED') AS BIGINT), max(risk_score)
  FROM enriched GROUP BY currency
  HAVING count(*) FILTER (WHERE status = 'COMPLETED') > 0)"""

_LOG = """
log AS (
  SELECT event_id, CAST(a AS INTEGER) AS attempt, 'sink-' || (user_id % 10) AS sink_key,
         ts + to_milliseconds([0, 50, 150, 350][a]) AS ts,
         CASE WHEN a = 1 + event_id % 5 THEN 'PUBLISHED'
              WHEN a % 2 = 0 THEN 'TIMED_OUT' ELSE 'FAILED' END AS outcome,
         CASE WHEN a <> 1 + event_id % 5 AND a % 2 = 0 THEN 5001
              ELSE event_id * 13 % 5000 END AS duration_ms
  FROM (SELECT *, unnest(generate_series(1, least(4, 1 + event_id % 5))) AS a FROM events))"""


def _payments(query: str) -> str:
    return f"WITH {_PAYMENTS} {query}"


def _enriched(query: str) -> str:
    return f"WITH {_ENRICHED} {query}"


def _log(query: str) -> str:
    return f"WITH {_LOG} {query}"


def _minute_rate(table: str) -> str:
    return f"""
SELECT make_timestamp(epoch_us(ts) // 60000000 * 60000000) AS window_start,
       count(*) AS n, count(*) / CAST(60 AS DOUBLE) AS per_second
FROM {table} GROUP BY 1"""


ORACLES = {
    "enrich_events": _enriched(
        "SELECT event_id, payment_id, direction, account, currency, minor_units, status, "
        "occurred_at, risk_score, ingest_latency_ms, processed_at FROM enriched"
    ),
    "ingest_latency": _enriched("SELECT event_id, ingest_latency_ms FROM enriched"),
    "terminal_events": _payments(
        "SELECT event_id, status FROM payments "
        "WHERE status IN ('COMPLETED', 'FAILED', 'REJECTED')"
    ),
    "positive_amounts": _payments(
        "SELECT event_id, minor_units FROM payments WHERE minor_units > 0"
    ),
    "currency_scale": _payments(
        "SELECT DISTINCT currency, CASE WHEN currency IN ('BTC', 'ETH') THEN 8 "
        "WHEN currency = 'USDC' THEN 6 ELSE 2 END AS scale FROM payments"
    ),
    "format_money": _payments(
        """
SELECT event_id,
       CASE WHEN minor_units < 0 THEN '-' ELSE '' END || (abs(minor_units) // unit) || '.'
         || lpad(CAST(abs(minor_units) % unit AS VARCHAR), scale, '0') || ' ' || currency
         AS amount_text
FROM (SELECT *, CAST(10 ** scale AS BIGINT) AS unit
      FROM (SELECT *, CASE WHEN currency IN ('BTC', 'ETH') THEN 8
                           WHEN currency = 'USDC' THEN 6 ELSE 2 END AS scale FROM payments))"""
    ),
    "money_add": _payments(
        """
SELECT a.event_id,
       CASE WHEN a.currency = b.currency THEN a.minor_units + b.minor_units END AS sum_minor,
       a.currency <> b.currency AS mismatch
FROM payments a JOIN payments b ON b.event_id = a.event_id + 1"""
    ),
    "encode_enriched": _enriched(
        """
SELECT event_id,
       '{"payment_id":"' || payment_id || '","direction":"' || direction || '","account":"'
         || account || '","amount":{"currency":"' || currency || '","minor_units":' || minor_units
         || '},"status":"' || status || '","occurred_at":"'
         || strftime(occurred_at, '%Y-%m-%dT%H:%M:%S.%fZ') || '","risk_score":' || risk_score
         || ',"ingest_latency_ms":' || ingest_latency_ms || ',"processed_at":"'
         || strftime(processed_at, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}' AS value
FROM enriched"""
    ),
    "record_keys": "SELECT event_id, md5(CAST(event_id // 8 AS VARCHAR)) AS key_hex FROM events",
    "total_processed": "SELECT count(*) AS n FROM events",
    "counts_by_status": _payments("SELECT status, count(*) AS n FROM payments GROUP BY status"),
    "counts_by_direction": _payments(
        "SELECT direction, count(*) AS n FROM payments GROUP BY direction"
    ),
    "settled_by_currency": _payments(
        "SELECT currency, CAST(sum(minor_units) AS BIGINT) AS settled_minor_units "
        "FROM payments WHERE status = 'COMPLETED' GROUP BY currency"
    ),
    "max_risk_score": _enriched(
        "SELECT coalesce(max(risk_score), 0) AS max_risk_score FROM enriched"
    ),
    "risk_score_distribution": _enriched(
        "SELECT risk_score, count(*) AS n FROM enriched GROUP BY risk_score"
    ),
    "aggregates_snapshot": f"WITH {_SNAPSHOT} SELECT * FROM snapshot",
    "aggregates_view": f"""
WITH {_SNAPSHOT}
SELECT 'totalProcessed' AS section, CAST(0 AS INTEGER) AS ord, 'all' AS name, n AS value
FROM snapshot WHERE dimension = 'total'
UNION ALL
SELECT 'maxRiskScore', 0, 'all', CAST(max_risk_score AS BIGINT)
FROM snapshot WHERE dimension = 'total'
UNION ALL
SELECT 'byStatus', list_position({_STATUSES}, key) - 1,
       CASE key WHEN 'INITIATED' THEN 'Initiated' WHEN 'COMPLIANCE_APPROVED' THEN
            'ComplianceApproved' WHEN 'FUNDS_RESERVED' THEN 'FundsReserved' WHEN 'RAIL_SETTLED'
            THEN 'RailSettled' WHEN 'LEDGER_POSTED' THEN 'LedgerPosted' WHEN 'COMPLETED' THEN
            'Completed' WHEN 'FAILED' THEN 'Failed' WHEN 'REJECTED' THEN 'Rejected' END, n
FROM snapshot WHERE dimension = 'status'
UNION ALL
SELECT 'byDirection', CASE key WHEN 'PAY_IN' THEN 0 ELSE 1 END,
       CASE key WHEN 'PAY_IN' THEN 'PayIn' ELSE 'PayOut' END, n
FROM snapshot WHERE dimension = 'direction'
UNION ALL
SELECT 'settled', list_position({_CURRENCIES}, key) - 1, key, settled_minor_units
FROM snapshot WHERE dimension = 'currency'""",
    "decode_events": _payments(
        'SELECT event_id AS "offset", payment_id, direction, account, currency, minor_units, '
        "status, occurred_at FROM payments WHERE event_id % 50 > 12"
    ),
    "poison_records": """
SELECT event_id AS "offset",
       CASE event_id % 50 WHEN 1 THEN 'missing_field' WHEN 3 THEN 'unknown_enum'
            WHEN 5 THEN 'bad_timestamp' WHEN 6 THEN 'bad_uuid' WHEN 7 THEN 'wrong_type'
            WHEN 10 THEN 'bad_uuid' WHEN 11 THEN 'bad_timestamp'
            ELSE 'malformed' END AS reject_reason
FROM events WHERE event_id % 50 < 13 AND event_id % 50 <> 4""",
    "tombstone_filter": 'SELECT event_id AS "offset" FROM events WHERE event_id % 50 <> 4',
    "publish_outcomes": _log(
        """
SELECT event_id, count(*) AS attempts,
       bool_or(outcome = 'PUBLISHED' AND duration_ms <= 5000) AS published,
       NOT bool_or(outcome = 'PUBLISHED' AND duration_ms <= 5000) AND count(*) >= 4 AS exhausted
FROM log GROUP BY event_id"""
    ),
    "published_count": _log(
        "SELECT count(DISTINCT event_id) AS n FROM log "
        "WHERE outcome = 'PUBLISHED' AND duration_ms <= 5000"
    ),
    "event_counters": _log(
        """
SELECT (SELECT count(*) FROM events) AS consumed,
       count(*) FILTER (WHERE outcome = 'PUBLISHED') AS published,
       count(*) FILTER (WHERE outcome = 'FAILED') AS publish_failed
FROM log"""
    ),
    "failure_streaks": _log(
        """
SELECT sink_key, min(ts) AS streak_start, count(*) AS streak_len,
       count(*) >= 5 AS reached_threshold
FROM (SELECT sink_key, ts, ok,
             sum(CAST(ok AS INTEGER)) OVER (PARTITION BY sink_key ORDER BY ts, event_id, attempt
               ROWS UNBOUNDED PRECEDING) AS successes
      FROM (SELECT *, outcome = 'PUBLISHED' AND duration_ms <= 5000 AS ok FROM log))
WHERE NOT ok GROUP BY sink_key, successes"""
    ),
    "slow_publishes": _log(
        "SELECT event_id, attempt, duration_ms FROM log WHERE duration_ms > 5000"
    ),
    "failure_rate_1m": _log(_minute_rate("log WHERE outcome = 'FAILED'")),
    "failure_alerts": _log(
        """
SELECT make_timestamp(min(tick) * 10000000) AS start, make_timestamp(max(tick) * 10000000) AS "end",
       count(*) AS evaluations
FROM (SELECT tick, tick - row_number() OVER (ORDER BY tick) AS run
      FROM (SELECT unnest(generate_series(bin + 1, bin + 30)) AS tick
            FROM (SELECT epoch_us(ts) // 10000000 AS bin FROM log WHERE outcome = 'FAILED'))
      GROUP BY tick HAVING count(*) / CAST(300 AS DOUBLE) > 0.01)
GROUP BY run HAVING (max(tick) - min(tick)) * 10 >= 300"""
    ),
    "event_rate_1m": _minute_rate("events"),
    "event_rate_sliding": """
SELECT make_timestamp((tick * 10 - 60) * 1000000) AS window_start, count(*) AS n,
       count(*) / CAST(60 AS DOUBLE) AS per_second
FROM (SELECT unnest(generate_series(epoch_us(ts) // 10000000 + 1, epoch_us(ts) // 10000000 + 6))
        AS tick FROM events)
GROUP BY tick""",
    "stalled_intervals": """
SELECT ts AS last_ts, next_ts, (epoch_us(next_ts) - epoch_us(ts)) // 1000 AS gap_ms
FROM (SELECT ts, lead(ts, 1, TIMESTAMP '2024-03-01 00:00:00') OVER (ORDER BY ts) AS next_ts FROM events)
WHERE epoch_us(next_ts) - epoch_us(ts) >= 900000000""",
    "token_bucket_admission": """
WITH RECURSIVE arrivals AS (
  SELECT event_id, user_id, epoch_us(ts) AS us,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
bucket AS (
  SELECT event_id, user_id, us, rn, true AS admitted, CAST(0 AS BIGINT) AS credit
  FROM arrivals WHERE rn = 1
  UNION ALL
  SELECT event_id, user_id, us, rn, refilled >= 7200000000,
         CASE WHEN refilled >= 7200000000 THEN refilled - 7200000000 ELSE refilled END
  FROM (SELECT a.*, least(7200000000, b.credit + a.us - b.us) AS refilled
        FROM arrivals a JOIN bucket b ON a.user_id = b.user_id AND a.rn = b.rn + 1))
SELECT event_id, user_id, admitted FROM bucket""",
    "token_bucket_burst": """
WITH RECURSIVE arrivals AS (
  SELECT event_id, user_id, epoch_us(ts) AS us,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, ts
        FROM events)),
bucket AS (
  SELECT event_id, user_id, us, rn, true AS admitted, CAST(4233600000000 AS BIGINT) AS credit
  FROM arrivals WHERE rn = 1
  UNION ALL
  SELECT event_id, user_id, us, rn, refilled >= 86400000000,
         CASE WHEN refilled >= 86400000000 THEN refilled - 86400000000 ELSE refilled END
  FROM (SELECT a.*, least(4320000000000, b.credit + a.us - b.us) AS refilled
        FROM arrivals a JOIN bucket b ON a.user_id = b.user_id AND a.rn = b.rn + 1))
SELECT event_id, user_id, admitted FROM bucket""",
}
