"""SQL for DuckDB with the same results as the queries, written independently of them.

DuckDB divides decimals as doubles, so averages and percentages are rounded here in whole numbers:
half up, as a decimal cast does.
"""

from __future__ import annotations

_BRONZE = """
e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
bronze AS (
  SELECT CAST(e.event_id AS VARCHAR) AS event_id, e.ts AS event_timestamp,
    CASE e.event_type WHEN 'purchase' THEN 'PAYMENT' WHEN 'view' THEN 'TRANSFER'
      WHEN 'click' THEN 'CASHOUT' WHEN 'signup' THEN 'CASHIN' ELSE 'BILLPAY' END AS transaction_type,
    'USER-' || CAST(e.user_id AS VARCHAR) AS user_id,
    '09' || lpad(CAST(e.user_id AS VARCHAR), 9, '0') AS phone_number,
    c.c_name AS user_name,
    CAST(CAST(e.value AS DECIMAL(14,2)) * 1000 AS DECIMAL(14,2)) AS amount_php,
    CASE WHEN e.k < 5 THEN NULL ELSE 'M-' || CAST(e.k AS VARCHAR) END AS merchant_id,
    s.s_name AS merchant_name,
    CASE e.k % 7 WHEN 0 THEN 'Food' WHEN 1 THEN 'Groceries' WHEN 2 THEN 'Transport' WHEN 3 THEN 'Bills'
      WHEN 4 THEN 'Remittance' WHEN 5 THEN 'E-commerce' ELSE 'Entertainment' END AS merchant_category,
    n.n_name AS province, c.c_mktsegment AS city,
    CASE e.k % 4 WHEN 0 THEN 'QR' WHEN 1 THEN 'InApp' WHEN 2 THEN 'Online' ELSE NULL END AS channel,
    e.event_id % 50 = 0 AS is_international,
    'DEVICE_' || CAST(e.user_id % 100 AS VARCHAR) AS device_id,
    '10.0.0.' || CAST(e.user_id % 256 AS VARCHAR) AS ip_address,
    CASE WHEN e.event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    e.ts + to_seconds(e.event_id % 20) AS processing_timestamp,
    s.s_nationkey AS geo_key, e.event_id AS event_no
  FROM e LEFT JOIN customer c ON c.c_custkey = e.user_id
    LEFT JOIN supplier s ON s.s_suppkey = e.k LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
),
typed AS (
  SELECT * EXCLUDE (phone_number, ip_address), sha256(phone_number) AS phone_hash, sha256(ip_address) AS ip_hash
  FROM bronze WHERE amount_php > 0
),
reasoned AS (
  SELECT *, CASE
      WHEN amount_php > 50000 AND hour(event_timestamp) <= 5 THEN 'HIGH_AMOUNT_NIGHT'
      WHEN amount_php > 10000 AND CAST(amount_php * 100 AS BIGINT) % 100000 = 0 THEN 'ROUND_AMOUNT'
      WHEN is_international AND amount_php > 30000 THEN 'INTERNATIONAL_HIGH_AMOUNT' END AS fraud_reason
  FROM typed
),
scored AS (
  SELECT *, CAST(CASE fraud_reason WHEN 'HIGH_AMOUNT_NIGHT' THEN 85 WHEN 'ROUND_AMOUNT' THEN 40
      WHEN 'INTERNATIONAL_HIGH_AMOUNT' THEN 65 ELSE 0 END AS DECIMAL(5,2)) AS fraud_score,
    coalesce(fraud_reason IN ('HIGH_AMOUNT_NIGHT', 'INTERNATIONAL_HIGH_AMOUNT'), false) AS fraud_flag
  FROM reasoned
),
facts AS (
  SELECT event_id AS transaction_id, event_timestamp, user_id, merchant_id, transaction_type, amount_php,
    channel, province, city, is_international, device_id, ip_hash, fraud_score, fraud_flag, fraud_reason,
    status, processing_timestamp, CAST(event_timestamp AS DATE) AS event_date
  FROM scored WHERE merchant_id IS NOT NULL
),
users AS (SELECT 'USER-' || CAST(c_custkey AS VARCHAR) AS user_id, c_name AS full_name FROM customer),
merchants AS (
  SELECT 'M-' || CAST(s_suppkey AS VARCHAR) AS merchant_id, s_name AS merchant_name,
    CASE s_suppkey % 7 WHEN 0 THEN 'Food' WHEN 1 THEN 'Groceries' WHEN 2 THEN 'Transport' WHEN 3 THEN 'Bills'
      WHEN 4 THEN 'Remittance' WHEN 5 THEN 'E-commerce' ELSE 'Entertainment' END AS category
  FROM supplier
)"""


def _sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([_BRONZE.strip(), *[c.strip() for c in ctes]]) + "\n" + body.strip()


def _cents(column: str) -> str:
    return f"CAST({column} * 100 AS HUGEINT)"


def _mean(total: str, n: str, dtype: str = "DECIMAL(12,2)") -> str:
    """total / n to two places, half up; both non-negative."""
    return f"CAST(CAST((2 * {_cents(total)} + {n}) // (2 * {n}) AS DECIMAL(18,0)) / 100 AS {dtype})"


def _percent(part: str, n: str, places: int = 2, dtype: str = "DECIMAL(5,2)") -> str:
    unit = 10**places
    scaled = f"(2 * CAST({part} AS HUGEINT) * 100 * {unit} + {n}) // (2 * {n})"
    return f"CAST(CAST({scaled} AS DECIMAL(18,0)) / {unit} AS {dtype})"


def _count_if(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


def _growth(today: str, before: str) -> str:
    change = f"({_cents(today)} - {_cents(before)})"
    size = f"(2 * abs({change}) * 10000 + {_cents(before)}) // (2 * {_cents(before)})"
    return f"CAST(CAST(sign({change}) * ({size}) AS DECIMAL(24,0)) / 100 AS DECIMAL(24,2))"


def _user_mart(rows: str) -> str:
    spend = "coalesce(CAST(sum(amount_php) FILTER (WHERE category = '{}') AS DECIMAL(12,2)), CAST(0 AS DECIMAL(12,2)))"
    return f"""(
  WITH x AS (SELECT f.*, m.merchant_name AS m_name, m.category, CAST(event_timestamp AS DATE) AS spend_date
             FROM {rows} f LEFT JOIN merchants m USING (merchant_id)),
  cat AS (SELECT user_id, spend_date, category AS v, row_number() OVER (PARTITION BY user_id, spend_date
            ORDER BY count(*) DESC, category) AS r FROM x WHERE category IS NOT NULL
            GROUP BY user_id, spend_date, category),
  mer AS (SELECT user_id, spend_date, m_name AS v, row_number() OVER (PARTITION BY user_id, spend_date
            ORDER BY count(*) DESC, m_name) AS r FROM x WHERE m_name IS NOT NULL
            GROUP BY user_id, spend_date, m_name),
  tot AS (SELECT user_id, spend_date, CAST(sum(amount_php) AS DECIMAL(16,2)) AS total_spend_php,
            count(*) AS transaction_count, {_mean('sum(amount_php)', 'count(*)')} AS avg_transaction_php,
            {spend.format('Food')} AS food_spend_php, {spend.format('Bills')} AS bills_spend_php,
            {spend.format('Transport')} AS transport_spend_php,
            {spend.format('E-commerce')} AS ecommerce_spend_php,
            {_count_if('fraud_flag')} AS fraud_alerts_today
          FROM x GROUP BY user_id, spend_date)
  SELECT tot.*, cat.v AS top_category, mer.v AS top_merchant FROM tot
    LEFT JOIN cat ON cat.user_id = tot.user_id AND cat.spend_date = tot.spend_date AND cat.r = 1
    LEFT JOIN mer ON mer.user_id = tot.user_id AND mer.spend_date = tot.spend_date AND mer.r = 1)"""


def _merchant_mart(rows: str, days: str = "= DATE '2024-01-15'") -> str:
    return f"""(
  WITH d AS (SELECT merchant_id, CAST(event_timestamp AS DATE) AS analysis_date,
      count(*) AS transaction_count, CAST(sum(amount_php) AS DECIMAL(18,2)) AS total_volume_php,
      {_mean('sum(amount_php)', 'count(*)')} AS avg_ticket_php,
      count(DISTINCT user_id) AS unique_customers, {_count_if("channel = 'QR'")} AS qr_count,
      {_count_if("channel = 'InApp'")} AS inapp_count, {_count_if("channel = 'Online'")} AS online_count,
      {_percent("count(*) FILTER (WHERE status = 'SUCCESS')", 'count(*)')} AS success_rate,
      {_count_if('fraud_flag')} AS fraud_incidents
    FROM {rows} GROUP BY ALL)
  SELECT d.*, {_growth('d.total_volume_php', 'p.total_volume_php')} AS growth_vs_yesterday
  FROM d LEFT JOIN d p ON p.merchant_id = d.merchant_id AND p.analysis_date = d.analysis_date - 1
  WHERE d.analysis_date {days})"""


def _hourly_mart(rows: str) -> str:
    micros = "CAST(date_diff('microsecond', event_timestamp, processing_timestamp) AS HUGEINT)"
    return f"""(
  SELECT date_trunc('hour', event_timestamp) AS window_hour, count(*) AS transaction_count,
    CAST(sum(amount_php) AS DECIMAL(16,2)) AS total_volume_php,
    {_count_if("transaction_type = 'PAYMENT'")} AS payment_count,
    {_count_if("transaction_type = 'TRANSFER'")} AS transfer_count,
    {_count_if("transaction_type = 'CASHOUT'")} AS cashout_count,
    {_percent("count(*) FILTER (WHERE status = 'SUCCESS')", 'count(*)')} AS success_rate,
    {_percent('count(*) FILTER (WHERE fraud_flag)', 'count(*)', 4, 'DECIMAL(7,4)')} AS fraud_rate,
    CAST(CAST((2 * sum({micros}) + 10 * count(*)) // (20 * count(*)) AS DECIMAL(18,0)) / 100
         AS DECIMAL(18,2)) AS avg_processing_ms
  FROM {rows}
  WHERE event_timestamp >= TIMESTAMP '2024-01-15 00:00:00' AND event_timestamp <= TIMESTAMP '2024-01-16 00:00:00'
  GROUP BY ALL)"""


_DAY = ("WHERE event_timestamp >= TIMESTAMP '2024-01-15 00:00:00'"
        " AND event_timestamp < TIMESTAMP '2024-01-16 00:00:00'")
_LAST_DAY = ("event_timestamp >= TIMESTAMP '2024-01-14 12:00:00'"
             " AND event_timestamp <= TIMESTAMP '2024-01-15 12:00:00'")
_LAST_HOUR = ("event_timestamp >= TIMESTAMP '2024-01-15 11:00:00'"
              " AND event_timestamp <= TIMESTAMP '2024-01-15 12:00:00'")
_STORED = "event_timestamp < TIMESTAMP '2024-01-01 06:00:00'"

_DIRTY = """
dirty AS (
  SELECT *, event_no % 16 AS kind, CASE
      WHEN event_no % 16 IN (7, 8) THEN 'MALFORMED_JSON'
      WHEN event_no % 16 = 6 THEN 'MISSING_EVENT_ID'
      WHEN event_no % 16 = 4 THEN 'MISSING_USER_ID'
      WHEN event_no % 16 = 5 THEN 'MISSING_TRANSACTION_TYPE'
      WHEN event_no % 16 = 2 THEN 'BAD_AMOUNT'
      WHEN event_no % 16 = 1 OR amount_php <= 0 THEN 'NON_POSITIVE_AMOUNT'
      WHEN event_no % 16 = 3 THEN 'BAD_TIMESTAMP' END AS reject_reason
  FROM bronze)"""

# The dimensions that facts_load and facts_orphans find stored.
_DIMS = """
known AS (SELECT * FROM typed WHERE merchant_name IS NOT NULL AND merchant_id IS NOT NULL),
all_facts AS (
  SELECT event_id AS transaction_id, event_timestamp, user_id, merchant_id, transaction_type, amount_php,
    channel, province, city, is_international, device_id, ip_hash, fraud_score, fraud_flag, fraud_reason,
    status, processing_timestamp, CAST(event_timestamp AS DATE) AS event_date,
    user_id IN (SELECT user_id FROM known) AS has_user,
    merchant_id IN (SELECT merchant_id FROM known) AS has_merchant
  FROM scored)"""


def _in_order(lat: str, lon: str) -> str:
    """Each event with what its user did before it; the places by `geo_key`."""
    return f"""
steps AS (
  SELECT *, {lat} AS lat, {lon} AS lon, epoch_us(event_timestamp) AS us
  FROM typed),
seen AS (
  SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY event_timestamp
      RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW) AS tx_in_window,
    lag(us) OVER w AS prev_us, lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon
  FROM steps WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp, event_id)),
chords AS (
  SELECT *, pow(sin(radians(lat - prev_lat) / 2), 2)
      + cos(radians(prev_lat)) * cos(radians(lat)) * pow(sin(radians(lon - prev_lon) / 2), 2) AS chord
  FROM seen),
measured AS (
  SELECT *, 2 * 6371.0 * asin(sqrt(CASE WHEN chord > 1 THEN 1.0 ELSE chord END)) AS km FROM chords),
hits AS (
  SELECT *, tx_in_window > 2 AS velocity_hit,
    coalesce(us - prev_us <= 3600000000 AND km > 100, false) AS location_hit,
    coalesce(us - prev_us >= 86400000000 AND amount_php >= 20000, false) AS dormant_hit
  FROM measured)"""


_IN_ORDER = _in_order("5 + (geo_key % 5) * 3", "117 + (geo_key // 5) * 2")

# Latitude and longitude of the known provinces' centres, in the order in which nations stand for them.
_CENTRES = [
    (14.60, 120.98), (10.32, 123.89), (7.07, 125.61), (14.28, 120.87), (14.17, 121.33), (14.84, 120.81), (15.03, 120.69),
    (13.76, 121.06), (14.59, 121.18), (10.67, 122.95), (10.72, 122.56), (16.41, 120.59), (16.04, 120.33), (8.48, 124.65),
    (7.83, 123.44), (6.11, 125.17), (11.24, 125.00), (9.74, 118.74), (9.65, 123.85),
]
_LOCATED = _in_order(*(f"CAST({[c[axis] for c in _CENTRES]}[geo_key % {len(_CENTRES)} + 1] AS DOUBLE)" for axis in (0, 1)))

_OPEN_ALERTS = "SELECT * FROM scored WHERE fraud_flag"

_FACT_LIMITS = {
    "transaction_id": 100, "user_id": 50, "merchant_id": 50, "transaction_type": 7, "channel": 20,
    "province": 8, "city": 100, "device_id": 64, "ip_hash": 64, "status": 20,
}


def _none_allowed(checks: dict[str, str], source: str) -> str:
    parts = [
        f"SELECT '{name}' AS \"check\", '= 0' AS expected, {_count_if(bad)} AS actual,"
        f" count(*) FILTER (WHERE {bad}) = 0 AS passed FROM {source}"
        for name, bad in checks.items()
    ]
    return "\nUNION ALL\n".join(parts)


def _completeness(columns: list[str], source: str) -> str:
    parts = []
    for c in columns:
        share = _percent(f"count({c})", "count(*)", 4, "DECIMAL(7,4)")
        parts.append(
            f"SELECT '{c}' AS \"check\", '> 99.9' AS expected, {share} AS actual,"
            f" {share} > 99.9 AS passed FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)


_FACT_COLUMNS = "SELECT * FROM facts"

_HOURS = f"""SELECT date_trunc('hour', event_timestamp) AS window_hour, count(*) AS transaction_count,
          CAST(sum(amount_php) AS DECIMAL(16,2)) AS total_volume_php,
          {_count_if("transaction_type = 'PAYMENT'")} AS payment_count,
          {_count_if("transaction_type = 'TRANSFER'")} AS transfer_count,
          {_count_if("transaction_type = 'CASHOUT'")} AS cashout_count,
          {_percent("count(*) FILTER (WHERE status = 'SUCCESS')", 'count(*)')} AS success_rate,
          {_percent('count(*) FILTER (WHERE fraud_flag)', 'count(*)', 4, 'DECIMAL(7,4)')} AS fraud_rate,
          CAST(CAST((2 * sum(epoch_us(processing_timestamp) - epoch_us(event_timestamp)) + 10 * count(*)) // (20 * count(*))
            AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2)) AS avg_processing_ms
        FROM scored GROUP BY 1"""

_STREAM_LIMIT = "(SELECT date_trunc('millisecond', max(event_timestamp)) - INTERVAL 10 MINUTES FROM typed)"


def _history_alerts(in_order: str, places: bool) -> str:
    """Alerts of all rules. Where payloads name places that are not known provinces, the location rule never applies."""
    return _sql(
        f"""SELECT event_id AS transaction_id, user_id, reason AS alert_type,
          CAST(CASE reason WHEN 'HIGH_AMOUNT_NIGHT' THEN 85 WHEN 'INTERNATIONAL_HIGH_AMOUNT' THEN 65
            WHEN 'VELOCITY_SPIKE' THEN 75 WHEN 'LOCATION_JUMP' THEN 90 WHEN 'DORMANT_REACTIVATION' THEN 70 END AS DECIMAL(5,2)) AS fraud_score
        FROM (SELECT hits.event_id, hits.user_id, CASE WHEN scored.fraud_reason IS NOT NULL THEN scored.fraud_reason
                WHEN velocity_hit THEN 'VELOCITY_SPIKE' WHEN {places} AND location_hit THEN 'LOCATION_JUMP'
                WHEN dormant_hit THEN 'DORMANT_REACTIVATION' END AS reason
              FROM hits JOIN scored ON scored.event_id = hits.event_id)
        WHERE reason <> 'ROUND_AMOUNT'""",
        in_order,
    )


ORACLE_SQL = {
    "bronze_parse": _sql(
        """SELECT event_id, strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_timestamp,
          transaction_type, user_id, phone_number, user_name, amount_php,
          merchant_id, merchant_name, merchant_category, province, city, channel, is_international,
          device_id, ip_address, status,
          strftime(processing_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS processing_timestamp
        FROM bronze"""
    ),
    "cleanse_valid": _sql(
        """SELECT event_id, event_timestamp, transaction_type, user_id, user_name, amount_php,
          merchant_id, merchant_name, merchant_category, province, city, channel, is_international,
          device_id, status, processing_timestamp, sha256(phone_number) AS phone_hash,
          sha256(ip_address) AS ip_hash
        FROM dirty WHERE reject_reason IS NULL""",
        _DIRTY,
    ),
    "quarantine": _sql("SELECT event_no, reject_reason FROM dirty WHERE reject_reason IS NOT NULL", _DIRTY),
    "pii_hash": _sql("SELECT event_id, phone_hash, ip_hash FROM typed"),
    "fraud_static": _sql("SELECT event_id, fraud_score, fraud_reason, fraud_flag FROM scored"),
    "fraud_band": _sql(
        """SELECT CASE WHEN fraud_score >= 60 THEN 'AUTO_FLAG' WHEN fraud_score >= 40 THEN 'MONITOR'
            ELSE 'NORMAL' END AS band, count(*) AS tx_count, CAST(sum(amount_php) AS DECIMAL(24,2)) AS volume
        FROM scored GROUP BY 1"""
    ),
    "fraud_alerts": _sql(
        """SELECT event_id AS transaction_id, user_id, merchant_id, fraud_reason AS alert_type, fraud_score,
          amount_php, province, event_timestamp, 'NEW' AS status, CAST(event_timestamp AS DATE) AS event_date
        FROM scored WHERE fraud_flag"""
    ),
    "rolling_count": _sql("SELECT event_id, user_id, tx_in_window FROM seen", _IN_ORDER),
    "velocity_spike": _sql(
        "SELECT event_id, user_id, event_timestamp, tx_in_window FROM hits WHERE velocity_hit", _IN_ORDER
    ),
    "location_jump": _sql(
        """SELECT event_id, user_id, event_timestamp, province, us - prev_us AS since_prev_us,
          CAST(round(km) AS BIGINT) AS km_from_prev FROM hits WHERE location_hit""",
        _IN_ORDER,
    ),
    "dormant": _sql(
        "SELECT event_id, user_id, amount_php, us AS event_us, prev_us FROM hits WHERE dormant_hit", _IN_ORDER
    ),
    "fraud_history": _sql(
        """SELECT event_id, CAST(CASE reason WHEN 'HIGH_AMOUNT_NIGHT' THEN 85 WHEN 'ROUND_AMOUNT' THEN 40
            WHEN 'INTERNATIONAL_HIGH_AMOUNT' THEN 65 WHEN 'VELOCITY_SPIKE' THEN 75 WHEN 'LOCATION_JUMP' THEN 90
            WHEN 'DORMANT_REACTIVATION' THEN 70 ELSE 0 END AS DECIMAL(5,2)) AS fraud_score,
          reason AS fraud_reason, coalesce(reason <> 'ROUND_AMOUNT', false) AS fraud_flag
        FROM (SELECT hits.event_id, CASE WHEN scored.fraud_reason IS NOT NULL THEN scored.fraud_reason
                WHEN velocity_hit THEN 'VELOCITY_SPIKE' WHEN location_hit THEN 'LOCATION_JUMP'
                WHEN dormant_hit THEN 'DORMANT_REACTIVATION' END AS reason
              FROM hits JOIN scored ON scored.event_id = hits.event_id)""",
        _IN_ORDER,
    ),
    "new_users_anti": _sql(
        f"""SELECT user_id, phone_hash, user_name AS full_name, province AS home_province, city AS home_city,
          'Level1' AS kyc_level, 'Active' AS account_status
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id) AS r
              FROM typed WHERE NOT {_STORED})
        WHERE r = 1 AND user_id NOT IN (SELECT user_id FROM typed WHERE {_STORED})"""
    ),
    "new_merchants_anti": _sql(
        f"""SELECT merchant_id, merchant_name, merchant_category AS category,
          CAST(NULL AS VARCHAR) AS subcategory, province, city, false AS is_partner,
          CAST(0 AS SMALLINT) AS risk_score
        FROM (SELECT *, row_number() OVER (PARTITION BY merchant_id ORDER BY event_timestamp, event_id) AS r
              FROM typed WHERE merchant_id IS NOT NULL AND NOT {_STORED})
        WHERE r = 1 AND merchant_id NOT IN
          (SELECT merchant_id FROM typed WHERE merchant_id IS NOT NULL AND {_STORED})"""
    ),
    "dedupe_first": _sql(
        """SELECT user_id, event_id, event_timestamp, amount_php, province, city
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id) AS r
              FROM typed) WHERE r = 1"""
    ),
    "facts_load": _sql(
        "SELECT * EXCLUDE (has_user, has_merchant) FROM all_facts WHERE has_user AND has_merchant", _DIMS
    ),
    "facts_orphans": _sql(
        """SELECT transaction_id, user_id, merchant_id, amount_php,
          CASE WHEN merchant_id IS NULL THEN 'NO_MERCHANT' WHEN NOT has_user THEN 'UNKNOWN_USER'
            ELSE 'UNKNOWN_MERCHANT' END AS orphan_reason
        FROM all_facts WHERE NOT (has_user AND coalesce(has_merchant, false))""",
        _DIMS,
    ),
    "load_replay": _sql(_FACT_COLUMNS),
    "load_redelivery": _sql(_FACT_COLUMNS),
    "stored_alerts": _sql(
        """SELECT event_id AS transaction_id, user_id, merchant_id, fraud_reason AS alert_type, fraud_score,
          amount_php, province, event_timestamp, 'NEW' AS status, CAST(event_timestamp AS DATE) AS event_date
        FROM scored WHERE fraud_flag"""
    ),
    "alert_ids": _sql(
        "SELECT count(*) AS alerts, count(*) AS ids, 0 AS without_id, count(*) AS recomputed FROM scored WHERE fraud_flag"
    ),
    "quarantine_reload": _sql(
        """SELECT 'damaged' AS step, count(*) AS rejected FROM dirty WHERE reject_reason IS NOT NULL
        UNION ALL SELECT 'repaired', count(*) FROM bronze WHERE NOT coalesce(amount_php > 0, false)""",
        _DIRTY,
    ),
    # what each of two micro-batches leaves, seen after its first run and after its second
    "quarantine_replay": _sql(
        """SELECT b.batch, CAST(run AS INTEGER) AS run, 'q-' || seen AS load_id, rejected
        FROM (SELECT count(*) AS rejected FROM dirty WHERE reject_reason IS NOT NULL),
             (VALUES ('ago', 'ago'), ('own', 'ago'), ('own', 'own')) AS b(batch, seen), range(1, 3) AS r(run)""",
        _DIRTY,
    ),
    "history_two_loads": _history_alerts(_IN_ORDER, False),
    "location_two_loads": _history_alerts(_LOCATED, True),
    "facts_by_partition": _sql(
        """SELECT event_date, count(*) AS tx_count, CAST(sum(amount_php) AS DECIMAL(24,2)) AS volume
        FROM facts GROUP BY event_date"""
    ),
    "mart_user_daily": _sql(f"SELECT * FROM {_user_mart(f'(SELECT * FROM facts {_DAY})')}"),
    "mart_user_daily_backfill": _sql(f"SELECT * FROM {_user_mart('facts')}"),
    "mart_merchant_daily": _sql(f"SELECT * FROM {_merchant_mart('facts')}"),
    "customers_approximate": _sql(
        "SELECT merchant_id, count(DISTINCT user_id) AS exact, true AS within FROM facts GROUP BY merchant_id"),
    "mart_merchant_stored": _sql(f"SELECT * FROM {_merchant_mart('facts')}"),
    "marts_after_late_load": _sql(f"SELECT * FROM {_merchant_mart('facts', 'IS NOT NULL')}"),
    "mart_hourly": _sql(f"SELECT * FROM {_hourly_mart('facts')}"),
    "merchant_growth": _sql(
        f"""SELECT d.*, {_growth('d.total_volume_php', 'p.total_volume_php')} AS growth_vs_yesterday
        FROM d LEFT JOIN d p ON p.merchant_id = d.merchant_id AND p.analysis_date = d.analysis_date - 1""",
        """d AS (SELECT merchant_id, CAST(event_timestamp AS DATE) AS analysis_date,
             CAST(sum(amount_php) AS DECIMAL(18,2)) AS total_volume_php FROM facts GROUP BY ALL)""",
    ),
    "merge_user_mart": _sql(
        "SELECT * FROM fresh UNION ALL SELECT * FROM stored s WHERE NOT EXISTS"
        " (SELECT 1 FROM fresh f WHERE f.user_id = s.user_id AND f.spend_date = s.spend_date)",
        "fresh AS (SELECT * FROM " + _user_mart(f"(SELECT * FROM facts {_DAY})") + ")",
        "stored AS (SELECT * FROM " + _user_mart(
            "(SELECT * FROM facts WHERE event_timestamp >= TIMESTAMP '2024-01-14 00:00:00'"
            " AND event_timestamp < TIMESTAMP '2024-01-15 12:00:00')"
        ) + ")",
    ),
    "merge_merchant_mart": _sql(
        """SELECT merchant_id, analysis_date, f.transaction_count, f.total_volume_php, f.avg_ticket_php,
          f.unique_customers, f.success_rate, f.fraud_incidents,
          CASE WHEN s.transaction_count IS NULL THEN f.qr_count ELSE s.qr_count END AS qr_count,
          CASE WHEN s.transaction_count IS NULL THEN f.inapp_count ELSE s.inapp_count END AS inapp_count,
          CASE WHEN s.transaction_count IS NULL THEN f.online_count ELSE s.online_count END AS online_count,
          CASE WHEN s.transaction_count IS NULL THEN f.growth_vs_yesterday
            ELSE s.growth_vs_yesterday END AS growth_vs_yesterday
        FROM fresh f LEFT JOIN stored s USING (merchant_id, analysis_date)""",
        "fresh AS (SELECT * FROM " + _merchant_mart("facts") + ")",
        "stored AS (SELECT * FROM " + _merchant_mart(
            "(SELECT * FROM facts WHERE event_timestamp < TIMESTAMP '2024-01-15 12:00:00')"
        ) + ")",
    ),
    "merge_hourly_mart": _sql(
        """SELECT window_hour, f.transaction_count, f.total_volume_php, f.success_rate, f.fraud_rate,
          coalesce(s.payment_count, f.payment_count) AS payment_count,
          coalesce(s.transfer_count, f.transfer_count) AS transfer_count,
          coalesce(s.cashout_count, f.cashout_count) AS cashout_count,
          coalesce(s.avg_processing_ms, f.avg_processing_ms) AS avg_processing_ms
        FROM fresh f LEFT JOIN stored s USING (window_hour)""",
        "fresh AS (SELECT * FROM " + _hourly_mart("facts") + ")",
        "stored AS (SELECT * FROM " + _hourly_mart(
            "(SELECT * FROM facts WHERE event_timestamp < TIMESTAMP '2024-01-15 12:30:00')"
        ) + ")",
    ),
    "alert_triage": _sql(
        """SELECT event_id AS transaction_id, fraud_reason AS alert_type,
          CASE WHEN fraud_score >= 85 THEN 'CONFIRMED' ELSE 'NEW' END AS status,
          CASE WHEN fraud_score >= 85 THEN 'analyst of ' || province END AS investigated_by,
          CASE WHEN fraud_score >= 85 THEN event_id END AS notes
        FROM scored WHERE fraud_flag"""
    ),
    "report_realtime": _sql(
        f"""SELECT count(*) AS total_transactions,
          coalesce(CAST(sum(amount_php) AS DECIMAL(24,2)), CAST(0 AS DECIMAL(24,2))) AS total_volume,
          CASE WHEN count(*) > 0 THEN {_mean('sum(amount_php)', 'greatest(count(*), 1)', 'DECIMAL(14,2)')} END
            AS avg_transaction,
          {_count_if('fraud_flag')} AS fraud_count, {_count_if("status = 'SUCCESS'")} AS success_count,
          count(DISTINCT user_id) AS active_users, count(DISTINCT merchant_id) AS active_merchants,
          {_percent("count(*) FILTER (WHERE status = 'SUCCESS')", 'greatest(count(*), 1)')} AS success_rate,
          {_percent('count(*) FILTER (WHERE fraud_flag)', 'greatest(count(*), 1)')} AS fraud_rate
        FROM facts WHERE {_LAST_HOUR}"""
    ),
    "report_hourly": _sql(
        f"""SELECT date_trunc('hour', event_timestamp) AS hour, count(*) AS tx_count,
          CAST(sum(amount_php) AS DECIMAL(24,2)) AS volume_php,
          {_mean('sum(amount_php)', 'count(*)', 'DECIMAL(14,2)')} AS avg_amount,
          {_count_if('fraud_flag')} AS fraud_count
        FROM facts WHERE {_LAST_DAY} GROUP BY 1"""
    ),
    "report_alerts": _sql(
        f"""SELECT a.event_id AS transaction_id, a.user_id, a.fraud_reason AS alert_type, a.fraud_score,
          a.amount_php, a.province, a.event_timestamp, 'NEW' AS status, u.full_name AS user_name,
          m.merchant_name
        FROM ({_OPEN_ALERTS} ORDER BY processing_timestamp DESC, event_id, fraud_reason LIMIT 20) a
          LEFT JOIN users u ON u.user_id = a.user_id LEFT JOIN merchants m ON m.merchant_id = a.merchant_id"""
    ),
    "report_open_alerts": _sql(
        f"SELECT user_id, fraud_reason AS alert_type, fraud_score, amount_php, 'NEW' AS status FROM ({_OPEN_ALERTS})"
    ),
    "report_category": _sql(
        f"""SELECT m.category, count(*) AS tx_count, CAST(sum(amount_php) AS DECIMAL(24,2)) AS total_volume,
          {_mean('sum(amount_php)', 'count(*)', 'DECIMAL(14,2)')} AS avg_amount
        FROM facts t JOIN merchants m USING (merchant_id) WHERE {_LAST_DAY} GROUP BY m.category"""
    ),
    "report_province": _sql(
        f"""SELECT province, count(*) AS tx_count, CAST(sum(amount_php) AS DECIMAL(24,2)) AS total_volume,
          {_count_if('fraud_flag')} AS fraud_count
        FROM facts WHERE {_LAST_DAY} GROUP BY province
        ORDER BY total_volume DESC, province NULLS FIRST LIMIT 10"""
    ),
    "report_top_merchants": _sql(
        f"""SELECT m.merchant_name, m.category, count(*) AS tx_count,
          CAST(sum(amount_php) AS DECIMAL(24,2)) AS total_volume
        FROM facts t JOIN merchants m USING (merchant_id) WHERE {_LAST_DAY}
        GROUP BY m.merchant_name, m.category
        ORDER BY total_volume DESC, m.merchant_name NULLS FIRST, m.category NULLS FIRST LIMIT 10"""
    ),
    "report_channel": _sql(
        f"""SELECT channel, count(*) AS tx_count, CAST(sum(amount_php) AS DECIMAL(24,2)) AS total_volume
        FROM facts WHERE {_LAST_DAY} GROUP BY channel"""
    ),
    "report_live_feed": _sql(
        """SELECT t.transaction_id, t.event_timestamp, u.full_name AS user_name, m.merchant_name, t.amount_php,
          t.channel, t.province, t.fraud_flag, t.fraud_score
        FROM facts t LEFT JOIN users u ON u.user_id = t.user_id
          LEFT JOIN merchants m ON m.merchant_id = t.merchant_id
        ORDER BY t.event_timestamp DESC, t.transaction_id LIMIT 100"""
    ),
    "report_live_fraud": _sql(
        """SELECT * FROM (
          SELECT t.transaction_id, t.event_timestamp, u.full_name AS user_name, m.merchant_name, t.amount_php,
            t.channel, t.province, t.fraud_flag, t.fraud_score
          FROM facts t LEFT JOIN users u ON u.user_id = t.user_id
            LEFT JOIN merchants m ON m.merchant_id = t.merchant_id
          ORDER BY t.event_timestamp DESC, t.transaction_id LIMIT 100) WHERE fraud_flag"""
    ),
    "dq_constraints": _sql(
        _none_allowed(
            {
                "transaction_id is null": "event_id IS NULL",
                "event_timestamp is null": "event_timestamp IS NULL",
                "transaction_type is null": "transaction_type IS NULL",
                "amount_php is null": "amount_php IS NULL",
                "merchant_id is null": "merchant_id IS NULL",
                "channel is null": "channel IS NULL",
                "amount_php not positive": "amount_php <= 0",
            },
            "scored",
        )
    ),
    "dq_pk_unique": _sql(
        """SELECT 'repeated transaction_id' AS "check", '= 0' AS expected, count(*) AS actual,
          count(*) = 0 AS passed
        FROM (SELECT transaction_id FROM facts GROUP BY 1 HAVING count(*) > 1)
        UNION ALL
        SELECT 'repeated user_id, merchant_id', '= 0', count(*), count(*) = 0
        FROM (SELECT user_id, merchant_id FROM facts GROUP BY ALL HAVING count(*) > 1)"""
    ),
    "dq_repeated_keys": _sql(
        "SELECT user_id, merchant_id, count(*) AS copies FROM facts GROUP BY ALL HAVING count(*) > 1"
    ),
    "dq_fk": _sql(
        f"""SELECT 'user_id without match' AS "check", '= 0' AS expected, count(*) AS actual,
          count(*) = 0 AS passed
        FROM facts WHERE user_id NOT IN (SELECT user_id FROM typed WHERE {_STORED})
        UNION ALL
        SELECT 'merchant_id without match', '= 0', count(*), count(*) = 0
        FROM facts WHERE merchant_id NOT IN
          (SELECT merchant_id FROM typed WHERE merchant_id IS NOT NULL AND {_STORED})"""
    ),
    "dq_length": _sql(
        _none_allowed(
            {f"{c} longer than {n}": f"length({c}) > {n}" for c, n in _FACT_LIMITS.items()}, "facts"
        )
    ),
    "dq_completeness": _sql(
        _completeness(
            ["event_id", "user_id", "merchant_id", "merchant_name", "province", "channel"], "typed"
        )
    ),
    "dq_mart_counts": _sql(
        f"""SELECT 'user mart rows' AS "check", '> 0' AS expected, count(*) AS actual, count(*) > 0 AS passed
        FROM (SELECT user_id FROM facts {_DAY} GROUP BY 1)
        UNION ALL
        SELECT 'merchant mart rows', '> 0', count(*), count(*) > 0
        FROM (SELECT merchant_id FROM facts {_DAY} GROUP BY 1)
        UNION ALL
        SELECT 'hourly mart rows', '> 0', count(*), count(*) > 0 FROM {_hourly_mart('facts')}"""
    ),
    "dq_freshness": _sql(
        """SELECT 'recent arrivals' AS "check", '> 0' AS expected, count(*) AS actual, count(*) > 0 AS passed,
          max(processing_timestamp) AS last_arrival
        FROM facts WHERE processing_timestamp BETWEEN TIMESTAMP '2024-01-15 11:00:00'
          AND TIMESTAMP '2024-01-15 12:00:00'"""
    ),
    "dq_profiles": _sql(
        "SELECT \"check\", expected, CAST(actual AS DECIMAL(24,4)) AS actual, passed FROM ("
        + _none_allowed(
            {
                **{f"{c} is null": f"{c} IS NULL" for c in ("transaction_id", "event_timestamp", "transaction_type", "amount_php")},
                "amount_php not positive": "amount_php <= 0",
                **{f"{c} longer than {n}": f"length({c}) > {n}" for c, n in (_FACT_LIMITS | {"transaction_type": 20, "province": 50}).items()},
            }, "facts",
        )
        + ") UNION ALL SELECT \"check\", expected, CAST(actual AS DECIMAL(24,4)), passed FROM ("
        + _completeness(["user_id", "merchant_id", "province", "channel"], "facts") + ")"
    ),
    "dq_topic_sample": """SELECT 'messages sampled' AS "check", '> 0' AS expected,
        least(count(*), 100) AS actual, count(*) > 0 AS passed FROM events""",
    "stream_facts": _sql(_FACT_COLUMNS),
    "stream_history": _history_alerts(_IN_ORDER, False),
    "stream_location": _history_alerts(_LOCATED, True),
    "dq_tables": """SELECT * FROM (VALUES ('dim_users', 'exists', 1, true), ('dim_merchants', 'exists', 1, true),
        ('fact_transactions', 'exists', 1, true), ('mart_daily_user_dashboard', 'exists', 1, true),
        ('mart_merchant_performance', 'exists', 1, true), ('mart_hourly_velocity', 'exists', 1, true),
        ('mart_fraud_alerts', 'exists', 1, true), ('silver tables', '>= 3', 3, true), ('gold tables', '>= 4', 4, true))
        AS t("check", expected, actual, passed)""",
    "stream_hourly_window": _sql(
        f"""{_HOURS}
        HAVING date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR <= {_STREAM_LIMIT}"""
    ),
    "stream_hourly_live": _sql(_HOURS),
    "stream_velocity_window": _sql(
        f"""SELECT user_id, window_start, window_start + INTERVAL 6 HOURS AS window_end, count(*) AS tx_count
        FROM (SELECT user_id, date_trunc('hour', event_timestamp) - to_hours(CAST(i AS INTEGER)) AS window_start
              FROM typed, range(6) AS r(i))
        GROUP BY ALL HAVING count(*) > 2 AND window_start + INTERVAL 6 HOURS <= {_STREAM_LIMIT}"""
    ),
    "stream_unique_events": _sql("SELECT event_id, user_id, event_timestamp, amount_php FROM typed"),
}
