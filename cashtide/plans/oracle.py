"""The same queries in SQL, over the tables events, orders and lineitem."""

# Building blocks (common table expressions) that state the derivation rules of the given tables.
_REST_NAMES = """
    CASE {k} WHEN 0 THEN 'RTGS-GBP-001' WHEN 1 THEN 'CHAPS-GBP-001' WHEN 2 THEN 'INTERNAL-GBP-001'
             WHEN 3 THEN 'NOSTRO-USD-001' WHEN 4 THEN 'NOSTRO-USD-002' WHEN 5 THEN 'NOSTRO-EUR-001'
             ELSE 'NOSTRO-EUR-002' END"""
_REST_CURRENCY = "CASE WHEN {k} <= 2 THEN 'GBP' WHEN {k} <= 4 THEN 'USD' ELSE 'EUR' END"


def _account(k):
    return _REST_NAMES.format(k=k)


def _currency(k):
    return _REST_CURRENCY.format(k=k)


PAYMENTS = f"""
payments AS (
  SELECT 'P' || event_id AS payment_id,
         {_currency('user_id % 7')} AS currency,
         {_account('user_id % 7')} AS settlement_account,
         CASE event_id % 3
           WHEN 0 THEN 1000000000 + CAST(ROUND(value * 100) AS BIGINT) * 1000000
           WHEN 1 THEN 100000000 + CAST(ROUND(value * 100) AS BIGINT) * 200000
           ELSE 10000000 + CAST(ROUND(value * 100) AS BIGINT) * 100000 END AS cents,
         CASE WHEN event_type IN ('purchase', 'click') OR (event_type = 'view' AND event_id % 2 = 0)
              THEN 'CREDIT' ELSE 'DEBIT' END AS direction,
         CASE event_id % 3 WHEN 0 THEN 'RTGS' WHEN 1 THEN 'CHAPS' ELSE 'INTERNAL' END AS rail,
         'C' || user_id AS counterparty,
         CAST(ts AS TIMESTAMP) AS event_time,
         event_id AS seq
  FROM events)"""

_RUN = "OVER (PARTITION BY currency, settlement_account ORDER BY event_time, seq ROWS UNBOUNDED PRECEDING)"
_IN = "CASE WHEN direction = 'CREDIT' THEN cents ELSE 0 END"
_OUT = "CASE WHEN direction = 'CREDIT' THEN 0 ELSE cents END"
_SIGNED = "CASE WHEN direction = 'CREDIT' THEN cents ELSE -cents END"


def _money(expr):
    return f"CAST({expr} AS DOUBLE) / 100.0"


LEDGER = f"""
ledger AS (
  SELECT *, SUM({_SIGNED}) {_RUN} AS balance, SUM({_IN}) {_RUN} AS t_in, SUM({_OUT}) {_RUN} AS t_out,
         COUNT(*) {_RUN} AS n
  FROM payments)"""

POSITIONS = f"""
positions AS (
  SELECT currency, settlement_account, SUM({_SIGNED}) AS balance, SUM({_IN}) AS t_in, SUM({_OUT}) AS t_out,
         COUNT(*) AS n, ARG_MAX(payment_id, (event_time, seq)) AS last_id, MAX(event_time) AS last_time
  FROM payments GROUP BY ALL)"""

UPDATES = f"""
offered AS (
  SELECT {_currency('o_custkey % 7')} AS currency,
         CASE WHEN o_orderkey % 50 = 1 THEN NULL ELSE {_account('o_custkey % 7')} END AS settlement_account,
         CASE o_custkey % 7 WHEN 0 THEN 20000000000 WHEN 1 THEN 5000000000 WHEN 2 THEN 500000000
              WHEN 3 THEN 10000000000 WHEN 4 THEN 2500000000 WHEN 5 THEN 7500000000 ELSE 2000000000 END
           + CAST(ROUND(o_totalprice * 100) AS BIGINT) * 10 AS w,
         CASE o_custkey % 7 WHEN 0 THEN 5000000000 WHEN 1 THEN 1000000000 WHEN 2 THEN 100000000
              WHEN 3 THEN 2500000000 WHEN 4 THEN 500000000 WHEN 5 THEN 1500000000 ELSE 400000000 END
           + CAST(ROUND(o_totalprice * 100) AS BIGINT) * 2 AS critical,
         TIMESTAMP '2024-01-01 00:00:00' + TO_SECONDS((o_orderkey * 7919) % 2592000) AS updated_at,
         'desk-' || (o_custkey % 5) AS updated_by,
         o_orderkey AS seq
  FROM orders),
updates AS (
  SELECT currency, settlement_account,
         CASE seq % 50 WHEN 2 THEN NULL WHEN 0 THEN critical ELSE w END AS warning, critical,
         updated_at, updated_by, seq
  FROM offered),
good_updates AS (SELECT * FROM updates WHERE seq % 50 NOT IN (0, 1)),
latest AS (
  SELECT * FROM good_updates
  QUALIFY ROW_NUMBER() OVER (PARTITION BY currency, settlement_account ORDER BY updated_at DESC, seq DESC) = 1)"""


def _alerts(source, name="alerts"):
    """Alert rows from ledger rows with bounds."""
    return f"""
{name} AS (
  SELECT CASE WHEN balance < critical THEN 'CRITICAL' ELSE 'WARNING' END AS alert_type,
         currency, settlement_account, balance,
         CASE WHEN balance < critical THEN critical ELSE warning END AS bound,
         payment_id, event_time AS triggered_at
  FROM {source} WHERE balance < critical OR balance < warning)"""


_ALERT_COLUMNS = f"""alert_type, currency, settlement_account, payment_id, triggered_at,
       {_money('balance')} AS available_balance, {_money('bound')} AS threshold_value,
       {_money('bound - balance')} AS breach_amount"""

LATEST_BOUNDS = """
bounded AS (
  SELECT l.*, t.warning, t.critical FROM ledger l LEFT JOIN latest t USING (currency, settlement_account))"""

ASOF_BOUNDS = """
bounded AS (
  SELECT l.*, t.warning, t.critical
  FROM ledger l ASOF LEFT JOIN (
    SELECT * FROM good_updates
    QUALIFY ROW_NUMBER() OVER (PARTITION BY currency, settlement_account, updated_at ORDER BY seq DESC) = 1) t
  ON l.currency = t.currency AND l.settlement_account = t.settlement_account AND l.event_time >= t.updated_at)"""

# The raw feed: every 97th event twice, faults by event_id % 100; text as it is sent.
FEED = f"""
{PAYMENTS},
sent AS (
  SELECT *, 0 AS copy, event_time AS arrived FROM payments
  UNION ALL
  SELECT *, 1 AS copy, event_time + INTERVAL 30 SECONDS AS arrived FROM payments WHERE seq % 97 = 0),
texts AS (
  SELECT *, seq % 100 AS fault, seq * 2 + copy AS pos, DATE_TRUNC('millisecond', arrived) AS at_ms,
    '{{"payment_id": ' || CASE WHEN seq % 100 = 11 THEN 'null' ELSE '"' || payment_id || '"' END
    || ', "currency": "' || CASE WHEN seq % 100 = 3 THEN 'CHF' ELSE currency END
    || '", "settlement_account": "' || settlement_account || '", '
    || CASE seq % 100 WHEN 2 THEN '' WHEN 6 THEN '"amount": "N/A", ' WHEN 7 THEN '"amount": -5000, '
         WHEN 8 THEN '"amount": 900000000, '
         ELSE '"amount": ' || (cents // 100) || '.' || LPAD(CAST(cents % 100 AS VARCHAR), 2, '0') || ', ' END
    || '"direction": "' || CASE WHEN seq % 100 = 4 THEN 'OUT' ELSE direction END
    || '", "rail": "' || CASE WHEN seq % 100 = 5 THEN 'SWIFT' ELSE rail END
    || '", "counterparty": "' || counterparty
    || '", "event_time": "' || CASE WHEN seq % 100 = 9 THEN 'yesterday'
         ELSE STRFTIME(arrived, '%Y-%m-%dT%H:%M:%S.%gZ') END || '"}}' AS message
  FROM sent),
judged AS (
  SELECT *,
    CASE fault WHEN 1 THEN 'not valid json {{{{ ' || payment_id WHEN 10 THEN '["' || payment_id || '"]'
         WHEN 12 THEN message || REPEAT('x', 600) WHEN 13 THEN message || ' ' || message
         WHEN 14 THEN message || '}}' ELSE message END AS raw,
    CASE WHEN fault IN (1, 12, 13, 14) THEN 'json_parse'
         WHEN fault IN (2, 3, 4, 5, 6, 7, 8, 10, 11) THEN 'schema_validation'
         WHEN cents NOT BETWEEN CASE rail WHEN 'RTGS' THEN 1000000000 WHEN 'CHAPS' THEN 100000000 ELSE 10000000 END
                        AND CASE rail WHEN 'RTGS' THEN 50000000000 WHEN 'CHAPS' THEN 10000000000 ELSE 5000000000 END
           THEN 'schema_validation'
         WHEN fault = 9 THEN 'timestamp_parse' END AS stage
  FROM texts),
valid AS (
  SELECT payment_id, currency, settlement_account, cents, direction, rail, counterparty,
         at_ms AS event_time, arrived, pos AS seq
  FROM judged WHERE stage IS NULL),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY currency, settlement_account, payment_id ORDER BY event_time, seq) AS rank
  FROM valid),
refused AS (
  SELECT SUBSTRING(raw, 1, 500) AS raw,
    CASE WHEN fault IN (1, 10, 11, 12, 13, 14) THEN NULL ELSE payment_id END AS payment_id,
    CASE WHEN fault IN (1, 12, 13, 14) THEN 'text is not JSON' ELSE CASE fault WHEN 10 THEN 'not a JSON object'
      WHEN 2 THEN 'field ''amount'' is absent'
      WHEN 3 THEN 'currency ''CHF'' is not among EUR, GBP, USD'
      WHEN 4 THEN 'direction ''OUT'' is not among CREDIT, DEBIT'
      WHEN 5 THEN 'rail ''SWIFT'' is not among CHAPS, INTERNAL, RTGS'
      WHEN 6 THEN 'amount ''N/A'' is no number' WHEN 7 THEN 'amount -5000.0 is not above zero'
      ELSE CASE
        WHEN stage = 'timestamp_parse' THEN 'event_time ''yesterday'' is no ISO time'
        WHEN fault = 8 OR stage = 'schema_validation' AND cents NOT BETWEEN
             CASE rail WHEN 'RTGS' THEN 1000000000 WHEN 'CHAPS' THEN 100000000 ELSE 10000000 END
             AND CASE rail WHEN 'RTGS' THEN 50000000000 WHEN 'CHAPS' THEN 10000000000 ELSE 5000000000 END
          THEN 'amount ' || FORMAT('{{:,}}', CASE WHEN fault = 8 THEN 900000000
                 ELSE CAST(ROUND_EVEN(cents / 100.0, 0) AS BIGINT) END)
               || ' does not fit ' || rail || CASE rail
                 WHEN 'RTGS' THEN ', which takes 10,000,000 to 500,000,000' WHEN 'CHAPS' THEN ', which takes 1,000,000 to 100,000,000'
                 ELSE ', which takes 100,000 to 50,000,000' END
        ELSE 'payment_id is empty' END END END AS error,
    stage, arrived AS detected_at
  FROM judged WHERE stage IS NOT NULL),
copies AS (
  SELECT payment_id, currency, settlement_account, {_money('cents')} AS amount, direction,
         'payment_id was taken before for ' || currency || ':' || settlement_account AS error,
         'duplicate_detection' AS stage, arrived AS detected_at
  FROM ranked WHERE rank > 1),
letters AS (
  SELECT raw, payment_id, NULL AS currency, NULL AS settlement_account, CAST(NULL AS DOUBLE) AS amount,
         NULL AS direction, error, stage, detected_at FROM refused
  UNION ALL
  SELECT NULL AS raw, payment_id, currency, settlement_account, amount, direction, error, stage, detected_at
  FROM copies)"""


def _flow(source):
    return f"""SELECT TIME_BUCKET(INTERVAL 5 MINUTES, event_time) AS window_start,
       TIME_BUCKET(INTERVAL 5 MINUTES, event_time) + INTERVAL 5 MINUTES AS window_end,
       currency, settlement_account, {_money(f'SUM({_SIGNED})')} AS net_flow, {_money(f'SUM({_IN})')} AS total_inbound,
       {_money(f'SUM({_OUT})')} AS total_outbound, COUNT(*) AS payment_count
  FROM {source} GROUP BY ALL"""


_POSITION_MONEY = f"""{_money('balance')} AS available_balance, {_money('t_in')} AS total_inbound,
       {_money('t_out')} AS total_outbound"""

PENDING_NOW = "TIMESTAMP '2024-01-15 12:00:00'"
NOW = "TIMESTAMP '2024-01-31 00:00:00'"

_PENDING_COLUMNS = f"""payment_id, currency, settlement_account, {_money('cents')} AS amount, direction, rail, counterparty,
         {PENDING_NOW} + TO_MINUTES((seq * 7) % 360 - 120) AS expected_settlement_time"""
PENDING = f"""
queued AS (
  SELECT {_PENDING_COLUMNS},
         CASE WHEN seq % 8 < 5 THEN 'PENDING' WHEN seq % 8 = 5 THEN 'SETTLED'
              WHEN seq % 8 = 6 THEN 'CANCELLED' ELSE 'FAILED' END AS status,
         {PENDING_NOW} - TO_HOURS(seq % 48) AS created_at
  FROM payments),
order_payments AS (
  SELECT 'O' || o_orderkey AS payment_id, {_currency('o_custkey % 7')} AS currency,
         {_account('o_custkey % 7')} AS settlement_account, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents,
         CASE WHEN o_orderstatus = 'O' THEN 'CREDIT' ELSE 'DEBIT' END AS direction,
         CASE o_orderkey % 3 WHEN 0 THEN 'RTGS' WHEN 1 THEN 'CHAPS' ELSE 'INTERNAL' END AS rail,
         'C' || o_custkey AS counterparty, o_orderkey AS seq
  FROM orders),
incoming AS (
  SELECT {_PENDING_COLUMNS}, 'PENDING' AS status, {PENDING_NOW} AS created_at FROM payments
  UNION ALL
  SELECT {_PENDING_COLUMNS}, 'PENDING' AS status, {PENDING_NOW} AS created_at FROM order_payments),
expired AS (
  SELECT * REPLACE (CASE WHEN status = 'PENDING' AND expected_settlement_time < {PENDING_NOW}
                         THEN 'SETTLED' ELSE status END AS status),
         status = 'PENDING' AND expected_settlement_time < {PENDING_NOW} AS was_due, FALSE AS is_new FROM queued),
merged AS (
  SELECT * FROM expired
  UNION ALL
  SELECT *, FALSE, TRUE FROM incoming i WHERE NOT EXISTS (SELECT 1 FROM queued q WHERE q.payment_id = i.payment_id)),
swept AS (
  SELECT *, status IN ('SETTLED', 'CANCELLED', 'FAILED') AND created_at < {PENDING_NOW} - INTERVAL 24 HOURS AS gone
  FROM merged)"""



def _health(now):
    return f"""
  SELECT rail, MAX(event_time) AS last_event_time, {now} AS last_check_time,
         {now} - INTERVAL 60 SECONDS > MAX(event_time) AS is_stale,
         CASE WHEN {now} - INTERVAL 60 SECONDS > MAX(event_time) THEN MAX(event_time) END AS stale_since,
         COUNT(*) FILTER (WHERE event_time > {now} - INTERVAL 1 MINUTE) AS event_count_1min
  FROM payments WHERE event_time <= {now} GROUP BY rail"""


_HEALTH = f"health AS ({_health(NOW)})"
HEALTH_NOW = "TIMESTAMP '2024-01-30 20:00:00'"


def _rail(table, topic, rail, name, who, cents):
    return f"""
  SELECT '{topic}' AS topic, {_currency(f'{who} % 7')} AS currency,
         CASE WHEN {who} % 50 = 0 THEN '' ELSE {_account(f'{who} % 7')} END AS account,
         {name} AS name, '{rail}' AS rail, CAST(ROUND({cents} * 100) AS BIGINT) AS cents FROM {table}"""


_RAILS = " UNION ALL ".join([
    _rail("events", "payments.rtgs", "RTGS", "'P' || event_id", "user_id", "value"),
    _rail("orders", "payments.chaps", "CHAPS", "'O' || o_orderkey", "o_custkey", "o_totalprice"),
    _rail("lineitem", "payments.internal", "INTERNAL", "'L' || l_orderkey || '-' || l_linenumber", "l_suppkey", "l_extendedprice"),
])

_FIRST_FEED = "feed_payments AS (SELECT * FROM ranked WHERE rank = 1)"
_FEED_LEDGER = LEDGER.replace("FROM payments)", "FROM feed_payments)")
_FEED_POSITIONS = POSITIONS.replace("FROM payments GROUP", "FROM feed_payments GROUP")

ORACLE = {
    "current_positions": f"""WITH {PAYMENTS}, {POSITIONS}
SELECT currency, settlement_account, n AS payment_count, last_id AS last_payment_id, last_time AS event_time,
       {_POSITION_MONEY} FROM positions""",
    "position_ledger": f"""WITH {PAYMENTS}, {LEDGER}
SELECT payment_id, currency, settlement_account, direction, rail, event_time, seq, n AS payment_count,
       {_money('cents')} AS amount, {_POSITION_MONEY} FROM ledger""",
    "position_ledger_daily": f"""WITH {PAYMENTS}, ledger AS (
  SELECT *, CAST(event_time AS DATE) AS business_date, SUM({_SIGNED}) OVER w AS balance, SUM({_IN}) OVER w AS t_in,
         SUM({_OUT}) OVER w AS t_out, COUNT(*) OVER w AS n
  FROM payments WINDOW w AS (PARTITION BY currency, settlement_account, CAST(event_time AS DATE)
                             ORDER BY event_time, seq ROWS UNBOUNDED PRECEDING))
SELECT payment_id, currency, settlement_account, business_date, {_POSITION_MONEY}, n AS payment_count FROM ledger""",
    "balance_timeline_8h": f"""WITH {PAYMENTS}, {LEDGER}
SELECT event_time AS time, {_money('balance')} AS value, settlement_account AS metric
FROM ledger WHERE event_time >= {NOW} - INTERVAL 8 HOURS ORDER BY time""",
    "recent_positions_8h": f"""WITH {PAYMENTS}, {POSITIONS}
SELECT last_time AS time, {_money('balance')} AS value, settlement_account AS metric
FROM positions WHERE last_time >= {NOW} - INTERVAL 8 HOURS ORDER BY time""",
    "position_gauge": f"""WITH {PAYMENTS}, {POSITIONS}, {UPDATES}
SELECT p.currency, p.settlement_account, {_money('balance')} AS available_balance,
       {_money('warning')} AS warning_threshold, {_money('critical')} AS critical_threshold,
       CASE WHEN balance < critical THEN 'red' WHEN balance < warning THEN 'orange' ELSE 'green' END AS colour
FROM positions p LEFT JOIN latest t ON p.currency = t.currency AND p.settlement_account = t.settlement_account""",
    "position_panel": f"""WITH {PAYMENTS}, {POSITIONS}
SELECT settlement_account AS metric, {_money('balance')} AS value FROM positions""",
    "liquidity_alerts": f"""WITH {PAYMENTS}, {LEDGER}, {UPDATES}, {LATEST_BOUNDS}, {_alerts('bounded')}
SELECT {_ALERT_COLUMNS} FROM alerts""",
    "alerts_asof_thresholds": f"""WITH {PAYMENTS}, {LEDGER}, {UPDATES}, {ASOF_BOUNDS}, {_alerts('bounded')}
SELECT {_ALERT_COLUMNS} FROM alerts""",
    "alert_topic_messages": f"""WITH {PAYMENTS}, {LEDGER}, {UPDATES}, {LATEST_BOUNDS}, {_alerts('bounded')}
SELECT CASE alert_type WHEN 'CRITICAL' THEN 'liquidity.critical' ELSE 'liquidity.warnings' END AS topic,
       currency || ':' || settlement_account AS key, 'alert' AS type, alert_type, payment_id,
       {_money('bound - balance')} AS breach_amount, EPOCH_US(triggered_at) // 1000 AS triggered_at_ts,
       STRFTIME(triggered_at, '%Y-%m-%dT%H:%M:%S.%gZ') AS triggered_at FROM alerts""",
    "flow_summary_5min": f"WITH {PAYMENTS} {_flow('payments')}",
    "flow_summary_feed": f"WITH {FEED} {_flow('valid')}",
    "flow_summary_dedup": f"WITH {FEED}, {_FIRST_FEED} {_flow('feed_payments')}",
    "net_flow_by_currency": f"""WITH {PAYMENTS}
SELECT TIME_BUCKET(INTERVAL 5 MINUTES, event_time) AS window_start, currency, {_money(f'SUM({_SIGNED})')} AS net_flow,
       COUNT(*) AS payment_count
FROM payments WHERE event_time >= {NOW} - INTERVAL 2 HOURS GROUP BY ALL""",
    "account_flow_panel": f"""WITH {PAYMENTS}, flows AS ({_flow('payments')})
SELECT window_start AS time, net_flow AS value, currency AS metric, settlement_account
FROM flows WHERE window_start >= {NOW} - INTERVAL 2 HOURS""",
    "latest_thresholds": f"""WITH {UPDATES}
SELECT currency, settlement_account, updated_at, updated_by, seq, {_money('warning')} AS warning_threshold,
       {_money('critical')} AS critical_threshold FROM latest""",
    "threshold_updates_rejected": f"""WITH {UPDATES}
SELECT seq, currency, settlement_account,
       CASE WHEN seq % 50 = 1 THEN 'missing settlement_account' ELSE 'warning must be above critical' END AS error
FROM updates WHERE seq % 50 IN (0, 1)""",
    "threshold_upsert": f"""WITH {UPDATES}
SELECT currency, settlement_account, {_money('warning')} AS warning_threshold,
       {_money('critical')} AS critical_threshold, updated_at, updated_by
FROM good_updates
QUALIFY ROW_NUMBER() OVER (PARTITION BY currency, settlement_account ORDER BY updated_at DESC, seq DESC) = 1""",
    "threshold_messages": f"""WITH {UPDATES}
SELECT 'liquidity.thresholds' AS topic, currency || ':' || settlement_account AS key,
       {_money('warning')} AS warning_threshold, {_money('critical')} AS critical_threshold, updated_by,
       STRFTIME(updated_at, '%Y-%m-%dT%H:%M:%S.%gZ') AS updated_at
FROM good_updates WHERE updated_at >= {PENDING_NOW}""",
    "payments_valid": f"""WITH {FEED}
SELECT payment_id, currency, settlement_account, direction, rail, counterparty, event_time, seq,
       {_money('cents')} AS amount FROM valid""",
    "payments_dlq": f"WITH {FEED} SELECT raw, payment_id, error, stage, detected_at FROM refused",
    "payments_dedup": f"""WITH {FEED}
SELECT payment_id, currency, settlement_account, direction, rail, counterparty, event_time, seq,
       {_money('cents')} AS amount FROM ranked WHERE rank = 1""",
    "duplicate_dlq": f"WITH {FEED} SELECT * FROM copies",
    "dlq_all": f"WITH {FEED} SELECT * FROM letters",
    "dlq_by_stage": f"WITH {FEED} SELECT stage, COUNT(*) AS records FROM letters GROUP BY stage",
    "dlq_by_stage_5min": f"""WITH {FEED}
SELECT TIME_BUCKET(INTERVAL 5 MINUTES, detected_at) AS window_start, stage, COUNT(*) AS records
FROM letters GROUP BY ALL""",
    "merged_rails": f"""WITH rails AS ({_RAILS})
SELECT topic, CASE WHEN account <> '' THEN currency || ':' || account END AS key,
       '{{"payment_id": "' || name || '", "currency": "' || currency || '", "settlement_account": "' || account
       || '", "amount": ' || (cents // 100) || '.' || LPAD(CAST(cents % 100 AS VARCHAR), 2, '0')
       || ', "rail": "' || rail || '"}}' AS value
FROM rails""",
    "feed_gaps": f"""WITH {PAYMENTS}, nexts AS (
  SELECT *, LEAD(event_time) OVER (PARTITION BY currency, settlement_account ORDER BY event_time, seq) AS next_time
  FROM payments WHERE event_time <= {NOW})
SELECT currency || ':' || settlement_account AS key, event_time AS stale_since,
       event_time + INTERVAL 7200 SECONDS AS detected_at, next_time AS recovered_at
FROM nexts WHERE COALESCE(next_time, {NOW}) > event_time + INTERVAL 7200 SECONDS""",
    "rail_health": f"WITH {PAYMENTS}, {_HEALTH} SELECT * FROM health",
    "feed_health_table": f"""WITH {PAYMENTS}, {_HEALTH}, older AS ({_health(PENDING_NOW)})
SELECT * FROM health WHERE rail <> 'CHAPS' UNION ALL SELECT * FROM older WHERE rail = 'CHAPS'""",
    "stream_feed_health": f"""WITH {PAYMENTS}, moved AS (
  SELECT * REPLACE (CASE WHEN rail = 'CHAPS' AND event_time >= TIMESTAMP '2024-01-30 00:00:00' THEN 'RTGS' ELSE rail END AS rail)
  FROM payments)
SELECT rail, CAST(MAX(event_time) < {HEALTH_NOW} - INTERVAL 12 HOURS AS INTEGER) AS value, MAX(event_time) AS last_event_time,
       COUNT(*) FILTER (WHERE event_time > {HEALTH_NOW} - INTERVAL 1 MINUTE) AS event_count_1min
FROM moved WHERE event_time <= {HEALTH_NOW} GROUP BY rail""",
    "feed_status": f"WITH {PAYMENTS}, {_HEALTH} SELECT rail, CAST(CASE WHEN is_stale THEN 1 ELSE 0 END AS INTEGER) AS value FROM health",
    "rail_volume_by_hours": f"""WITH {PAYMENTS}
SELECT rail, STRFTIME(event_time, '%H:%M') BETWEEN '07:00' AND '18:00' AS in_business_hours,
       COUNT(*) AS payment_count, {_money('SUM(cents)')} AS amount FROM payments GROUP BY ALL""",
    "pending_refreshed": f"WITH {PAYMENTS}, {PENDING} SELECT * EXCLUDE (was_due, is_new, gone) FROM swept WHERE NOT gone",
    "pending_refresh_summary": f"""WITH {PAYMENTS}, {PENDING}
SELECT (SELECT COUNT(*) FROM incoming) AS generated, COUNT(*) FILTER (WHERE is_new) AS inserted,
       COUNT(*) FILTER (WHERE was_due) AS expired, COUNT(*) FILTER (WHERE gone) AS deleted FROM swept""",
    "pending_queue": f"""WITH {PAYMENTS}, {PENDING}
SELECT payment_id, expected_settlement_time, currency, settlement_account, amount, direction, rail, counterparty
FROM queued WHERE status = 'PENDING'
  AND expected_settlement_time BETWEEN {PENDING_NOW} AND {PENDING_NOW} + INTERVAL 2 HOURS
ORDER BY expected_settlement_time, payment_id LIMIT 50""",
    "pending_top10_debits": f"""WITH {PAYMENTS}, {PENDING}
SELECT amount, currency, settlement_account, expected_settlement_time, counterparty, payment_id
FROM queued WHERE status = 'PENDING' AND direction = 'DEBIT'
  AND expected_settlement_time BETWEEN {PENDING_NOW} AND {PENDING_NOW} + INTERVAL 2 HOURS
ORDER BY amount DESC, payment_id LIMIT 10""",
    "stream_flow_summary": f"""WITH {FEED}, flows AS ({_flow('valid')})
SELECT * FROM flows WHERE window_end <= (SELECT MAX(event_time) - INTERVAL 1 SECOND FROM valid)""",
    "stream_positions": f"""WITH {FEED}, {_FIRST_FEED}, {_FEED_POSITIONS}
SELECT currency, settlement_account, {_POSITION_MONEY}, n AS payment_count, last_id AS last_payment_id,
       last_time AS event_time FROM positions""",
    "stream_alerts": f"""WITH {FEED}, {_FIRST_FEED}, {_FEED_LEDGER}, {UPDATES},
{ASOF_BOUNDS.replace('l.event_time >=', 'l.arrived >=')}, {_alerts('bounded')}
SELECT {_ALERT_COLUMNS} FROM alerts""",
    "stream_dlq": f"WITH {FEED} SELECT * EXCLUDE (detected_at) FROM letters",
}

ORACLE["batch_stream_positions"] = ORACLE["stream_positions"]
ORACLE["stream_positions_many_batches"] = f"SELECT * EXCLUDE (last_payment_id, event_time) FROM ({ORACLE['stream_positions']})"
ORACLE["batch_stream_alerts"] = ORACLE["stream_alerts"]

ORACLE["stream_feed_events"] = ORACLE["feed_gaps"]
ORACLE["stream_restart"] = f"""SELECT * EXCLUDE (last_payment_id, event_time), payment_count AS ids_in_state
FROM ({ORACLE['stream_positions']})
JOIN (WITH {FEED} SELECT currency, settlement_account, COUNT(*) AS sightings FROM valid GROUP BY ALL) USING (currency, settlement_account)"""

# Ids are remembered for a day after their last message.
ORACLE["stream_id_ttl"] = f"""WITH {FEED}, resent AS (
  SELECT currency, settlement_account, payment_id, arrived, seq FROM valid
  UNION ALL
  SELECT currency, settlement_account, payment_id, arrived + INTERVAL 3 DAYS, seq + 1099511627776 FROM valid WHERE seq % 194 = 0),
before AS (
  SELECT *, LAG(arrived) OVER (PARTITION BY currency, settlement_account, payment_id ORDER BY arrived, seq) AS last_seen FROM resent)
SELECT payment_id, COUNT(*) FILTER (WHERE last_seen IS NULL OR arrived >= last_seen + INTERVAL 1 DAY) AS accepted,
       COUNT(*) FILTER (WHERE arrived < last_seen + INTERVAL 1 DAY) AS refused
FROM before GROUP BY payment_id"""

# Rows come in four batches.  A window drops the rows of a batch if it had ended, one second ago or more, before
# the newest row of the batches up to the last but one.
ORACLE["stream_late_rows"] = f"""WITH {FEED}, {_FIRST_FEED}, {_FEED_POSITIONS},
quarters AS (
  SELECT *, CAST(event_time >= TIMESTAMP '2024-01-08 00:00:00' AS INTEGER) + CAST(event_time >= TIMESTAMP '2024-01-15 00:00:00' AS INTEGER)
         + CAST(event_time >= TIMESTAMP '2024-01-23 00:00:00' AS INTEGER) AS quarter
  FROM payments),
numbered AS (
  SELECT *, CASE WHEN seq % 50 = 7 AND quarter < 2 THEN quarter + 2 ELSE quarter END AS batch,
         TIME_BUCKET(INTERVAL 5 MINUTES, event_time) AS window_start FROM quarters),
marks AS (
  SELECT b.batch, (SELECT MAX(event_time) FROM numbered n WHERE n.batch < b.batch - 1) - INTERVAL 1 SECOND AS mark
  FROM (SELECT DISTINCT batch FROM numbered) b),
windowed AS (
  SELECT *, COALESCE(window_start + INTERVAL 5 MINUTES <= mark, FALSE) AS late FROM numbered JOIN marks USING (batch)),
per_account AS (
  SELECT currency, settlement_account, COUNT(DISTINCT window_start) AS windows, COUNT(*) AS in_windows
  FROM windowed WHERE NOT late GROUP BY ALL)
SELECT currency, settlement_account, {_money('balance')} AS available_balance, n AS in_balance, windows, in_windows,
       (SELECT COUNT(*) FROM windowed WHERE late) AS late_rows
FROM positions JOIN per_account USING (currency, settlement_account)"""

# Of 40 messages one is malformed and one a deletion.
ORACLE["stream_thresholds_applied"] = f"""WITH {UPDATES},
messages AS (
  SELECT currency || ':' || COALESCE(settlement_account, '') AS key, updated_at, seq, seq % 40 = 6 AS deleted,
         CASE WHEN seq % 40 <> 6 THEN warning END AS warning, CASE WHEN seq % 40 <> 6 THEN critical END AS critical
  FROM updates
  WHERE seq % 40 <> 5 AND settlement_account IS NOT NULL AND (seq % 40 = 6 OR seq % 50 <> 0)),
held AS (
  SELECT * FROM messages WHERE updated_at < {PENDING_NOW} QUALIFY ROW_NUMBER() OVER (PARTITION BY key ORDER BY seq DESC) = 1)
SELECT key, {_money('warning')} AS warning, {_money('critical')} AS critical FROM held WHERE NOT deleted
UNION ALL
SELECT key, {_money('warning')} AS warning, {_money('critical')} AS critical FROM messages WHERE updated_at >= {PENDING_NOW}"""
