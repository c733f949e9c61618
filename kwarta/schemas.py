"""Declared schemas of the event payload and of every stored table, and their constraints."""

from __future__ import annotations

from pyspark.sql import types as T


TEXT, FLAG, DAY, INSTANT = T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType()
SHORT, LONG, DOUBLE, BYTES = T.ShortType(), T.LongType(), T.DoubleType(), T.BinaryType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# The JSON payload. Amount and timestamp arrive as text and are typed by the cleansing step.
BRONZE = _struct(
    event_id=TEXT, event_timestamp=TEXT, transaction_type=TEXT, user_id=TEXT, phone_number=TEXT,
    user_name=TEXT, amount_php=TEXT, merchant_id=TEXT, merchant_name=TEXT, merchant_category=TEXT,
    province=TEXT, city=TEXT, channel=TEXT, is_international=FLAG, device_id=TEXT, ip_address=TEXT,
)

USERS = _struct(
    user_id=TEXT, phone_hash=TEXT, full_name=TEXT, home_province=TEXT, home_city=TEXT, kyc_level=TEXT,
    account_status=TEXT, registration_date=DAY, created_at=INSTANT, updated_at=INSTANT,
)

MERCHANTS = _struct(
    merchant_id=TEXT, merchant_name=TEXT, category=TEXT, subcategory=TEXT, province=TEXT, city=TEXT,
    is_partner=FLAG, onboarding_date=DAY, risk_score=SHORT, created_at=INSTANT, updated_at=INSTANT,
)

# event_date is the partition column; it is derived from event_timestamp.
FACTS = _struct(
    transaction_id=TEXT, event_timestamp=INSTANT, user_id=TEXT, merchant_id=TEXT, transaction_type=TEXT,
    amount_php=T.DecimalType(14, 2), channel=TEXT, province=TEXT, city=TEXT, is_international=FLAG,
    device_id=TEXT, ip_hash=TEXT, fraud_score=T.DecimalType(5, 2), fraud_flag=FLAG, fraud_reason=TEXT,
    status=TEXT, processing_timestamp=INSTANT, event_date=DAY,
)

QUARANTINE = _struct(
    payload=TEXT, reject_reason=TEXT, processing_timestamp=INSTANT, load_id=TEXT, load_group=TEXT,
    arrival_date=DAY,
)

ALERTS = _struct(
    alert_id=LONG, transaction_id=TEXT, user_id=TEXT, merchant_id=TEXT, alert_type=TEXT,
    fraud_score=T.DecimalType(5, 2), amount_php=T.DecimalType(14, 2), province=TEXT, event_timestamp=INSTANT,
    status=TEXT, investigated_by=TEXT, notes=TEXT, created_at=INSTANT, resolved_at=INSTANT, event_date=DAY,
)

# Every valid event that was loaded: its key, where it lies, and the load that brought it.
EVENT_KEYS = _struct(transaction_id=TEXT, event_date=DAY, load_id=TEXT)
# The keys of the dimensions' rows, and the load that met them first.
USER_KEYS = _struct(user_id=TEXT, load_id=TEXT)
MERCHANT_KEYS = _struct(merchant_id=TEXT, load_id=TEXT)

# What the history rules look back on: each event's user, instant and place; and, per user and stretch of the
# dormancy gap, the first and the last instant.
ACTIVITY = _struct(
    user_id=TEXT, event_id=TEXT, event_timestamp=INSTANT, lat=DOUBLE, lon=DOUBLE, load_id=TEXT, event_date=DAY,
)
STRETCHES = _struct(user_id=TEXT, stretch=LONG, first_us=LONG, last_us=LONG, load_id=TEXT)

# Analysts' decisions, only ever appended.
DECISIONS = _struct(alert_id=LONG, status=TEXT, investigated_by=TEXT, notes=TEXT, resolved_at=INSTANT)

USER_DAILY = _struct(
    user_id=TEXT, total_spend_php=T.DecimalType(16, 2), transaction_count=LONG,
    avg_transaction_php=T.DecimalType(12, 2), top_category=TEXT, top_merchant=TEXT,
    food_spend_php=T.DecimalType(12, 2), bills_spend_php=T.DecimalType(12, 2),
    transport_spend_php=T.DecimalType(12, 2), ecommerce_spend_php=T.DecimalType(12, 2),
    fraud_alerts_today=LONG, created_at=INSTANT, spend_date=DAY,
)

# growth_vs_yesterday is wider than the (6,2) one would expect: a merchant that goes from one
# centavo to a normal day grows by more than 9999.99 %, and ANSI casts raise on overflow.
MERCHANT_DAILY = _struct(
    merchant_id=TEXT, transaction_count=LONG, total_volume_php=T.DecimalType(18, 2),
    avg_ticket_php=T.DecimalType(12, 2), unique_customers=LONG, qr_count=LONG, inapp_count=LONG,
    online_count=LONG, success_rate=T.DecimalType(5, 2), fraud_incidents=LONG,
    growth_vs_yesterday=T.DecimalType(24, 2), created_at=INSTANT, analysis_date=DAY,
)

# A sketch of each merchant's customers on each day, from which those of any period can be told.
CUSTOMERS = _struct(merchant_id=TEXT, customers=BYTES, analysis_date=DAY)

# What a check of a day's facts has counted.
PROFILES = _struct(measure=TEXT, value=LONG, event_date=DAY)

# fraud_rate is a percentage and avg_processing_ms has no natural bound, hence the widths.
HOURLY = _struct(
    window_hour=INSTANT, transaction_count=LONG, total_volume_php=T.DecimalType(16, 2), payment_count=LONG,
    transfer_count=LONG, cashout_count=LONG, success_rate=T.DecimalType(5, 2), fraud_rate=T.DecimalType(7, 4),
    avg_processing_ms=T.DecimalType(18, 2), created_at=INSTANT, window_date=DAY,
)

PRIMARY_KEYS = {
    "dim_users": ["user_id"],
    "dim_merchants": ["merchant_id"],
    "fact_transactions": ["transaction_id"],
    "mart_daily_user_dashboard": ["user_id", "spend_date"],
    "mart_fraud_alerts": ["transaction_id", "alert_type"],
    "mart_merchant_performance": ["merchant_id", "analysis_date"],
    "mart_hourly_velocity": ["window_hour"],
}

# Columns that must be present, and the longest text each may hold.
NOT_NULL = {
    "dim_users": ["user_id"],
    "dim_merchants": ["merchant_id"],
    "fact_transactions": ["transaction_id", "event_timestamp", "transaction_type", "amount_php"],
}

MAX_LENGTH = {
    "dim_users": {
        "user_id": 50, "phone_hash": 64, "full_name": 150, "home_province": 50,
        "home_city": 50, "kyc_level": 20, "account_status": 20,
    },
    "dim_merchants": {
        "merchant_id": 50, "merchant_name": 200, "category": 50, "subcategory": 50,
        "province": 50, "city": 100,
    },
    "fact_transactions": {
        "transaction_id": 100, "user_id": 50, "merchant_id": 50, "transaction_type": 20,
        "channel": 20, "province": 50, "city": 100, "device_id": 64, "ip_hash": 64, "status": 20,
    },
    "mart_daily_user_dashboard": {"user_id": 50, "top_category": 50, "top_merchant": 200},
    "mart_fraud_alerts": {
        "transaction_id": 100, "user_id": 50, "merchant_id": 50, "alert_type": 100,
        "province": 50, "status": 20, "investigated_by": 100,
    },
    "mart_merchant_performance": {"merchant_id": 50},
}
