import hashlib
from decimal import Decimal

import pytest
from make import payload

from kwarta.plans import silver


def cleansed(spark, *values):
    raw = spark.createDataFrame([(v,) for v in values], "value string")
    return silver.cleanse(silver.parse(raw))


@pytest.mark.parametrize("value, reason", [
    ("not json", "MALFORMED_JSON"),
    ("[" + payload() + "]", "MALFORMED_JSON"),
    ("{}", "MALFORMED_JSON"),
    ('{"event_id":"c"}', "MISSING_USER_ID"),
    (payload(event_id=None), "MISSING_EVENT_ID"),
    (payload(transaction_type=None), "MISSING_TRANSACTION_TYPE"),
    (payload(amount_php="x"), "BAD_AMOUNT"),
    (payload(amount_php=None), "BAD_AMOUNT"),
    (payload(amount_php=10**13), "BAD_AMOUNT"),
    (payload(amount_php=-1), "NON_POSITIVE_AMOUNT"),
    (payload(amount_php=0), "NON_POSITIVE_AMOUNT"),
    (payload(event_timestamp="yesterday"), "BAD_TIMESTAMP"),
    (payload(), None),
    (payload(amount_php="100.00"), None),
    (payload(amount_php=0.01), None),
    (payload(is_international="maybe"), None),
    (payload(merchant_id=None), None),
])
def test_reason(spark, value, reason):
    row = cleansed(spark, value).first()
    assert row.reject_reason == reason
    assert row.payload == value


def test_null_payloads_are_dropped_and_bytes_are_read(spark):
    raw = spark.createDataFrame([(None,), (bytearray(payload().encode()),)], "value binary")
    assert silver.parse(raw).count() == 1


def test_valid_and_quarantine_split_the_input(spark):
    both = cleansed(spark, "not json", payload(), payload(amount_php=-5))
    good, bad = silver.valid(both), silver.quarantined(both)
    assert good.count() == 1 and bad.count() == 2
    assert "payload" not in good.columns and "phone_number" not in good.columns


def test_typed_and_masked(spark):
    row = silver.valid(cleansed(spark, payload(amount_php=12.5, phone_number="0917", ip_address=None))).first()
    assert row.amount_php == Decimal("12.50")
    assert row.event_timestamp.isoformat() == "2024-01-15T12:00:00"
    assert row.phone_hash == hashlib.sha256(b"0917").hexdigest()
    assert row.ip_hash is None
    assert row.status == "SUCCESS"


def test_publish_and_parse_are_inverse(spark):
    before = silver.parse(spark.createDataFrame([(payload(),)], "value string")).drop("payload")
    after = silver.parse(silver.publish(before)).drop("payload")
    assert before.collect() == after.collect()
