"""Hand-made rows."""

import json
from datetime import datetime
from decimal import Decimal

from pyspark.sql import types as T

ROW = T.StructType([
    T.StructField("event_id", T.StringType()), T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("transaction_type", T.StringType()), T.StructField("user_id", T.StringType()),
    T.StructField("user_name", T.StringType()), T.StructField("amount_php", T.DecimalType(14, 2)),
    T.StructField("merchant_id", T.StringType()), T.StructField("merchant_name", T.StringType()),
    T.StructField("merchant_category", T.StringType()), T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()), T.StructField("channel", T.StringType()),
    T.StructField("is_international", T.BooleanType()), T.StructField("device_id", T.StringType()),
    T.StructField("phone_hash", T.StringType()), T.StructField("ip_hash", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("processing_timestamp", T.TimestampType()),
])

DEFAULTS = dict(
    transaction_type="PAYMENT", user_id="u1", user_name="Ana", amount_php="100.00", merchant_id="m1",
    merchant_name="Shop", merchant_category="Food", province="Cebu", city="Cebu City", channel="QR",
    is_international=False, device_id="d", phone_hash="p", ip_hash="i", status="SUCCESS",
)


def ts(text):
    return datetime.fromisoformat(text)


def rows(spark, *records):
    """Valid silver rows; each record names what differs from the defaults."""
    out = []
    for n, record in enumerate(records):
        full = {**DEFAULTS, "event_id": f"e{n:04d}", "event_timestamp": ts("2024-01-15 12:00:00"), **record}
        if isinstance(full["event_timestamp"], str):
            full["event_timestamp"] = ts(full["event_timestamp"])
        full.setdefault("processing_timestamp", full["event_timestamp"])
        full["amount_php"] = Decimal(full["amount_php"])
        out.append(tuple(full[f.name] for f in ROW.fields))
    return spark.createDataFrame(out, ROW)


def payload(**fields):
    base = dict(
        event_id="e1", event_timestamp="2024-01-15T12:00:00Z", transaction_type="PAYMENT", user_id="u1",
        phone_number="0917", user_name="Ana", amount_php=100.0, merchant_id="m1", merchant_name="Shop",
        merchant_category="Food", province="Cebu", city="Cebu City", channel="QR",
        is_international=False, device_id="d", ip_address="10.0.0.1",
    )
    return json.dumps({k: v for k, v in {**base, **fields}.items() if v is not None})
