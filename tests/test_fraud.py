from decimal import Decimal

import pytest
from make import rows

from kwarta.operators import fraud
from kwarta.plans import silver


@pytest.mark.parametrize("amount, time, abroad, score, reason", [
    ("50000.00", "02:00:00", False, 40, "ROUND_AMOUNT"),
    ("50000.01", "02:00:00", False, 85, "HIGH_AMOUNT_NIGHT"),
    ("50000.01", "05:59:59", False, 85, "HIGH_AMOUNT_NIGHT"),
    ("50000.01", "06:00:00", False, 0, None),
    ("50000.01", "23:59:59", False, 0, None),
    ("50000.01", "00:00:00", False, 85, "HIGH_AMOUNT_NIGHT"),
    ("10000.00", "12:00:00", False, 0, None),
    ("11000.00", "12:00:00", False, 40, "ROUND_AMOUNT"),
    ("11000.01", "12:00:00", False, 0, None),
    ("30000.00", "12:00:00", True, 40, "ROUND_AMOUNT"),
    ("30000.01", "12:00:00", True, 65, "INTERNATIONAL_HIGH_AMOUNT"),
    ("30000.01", "12:00:00", None, 0, None),
    ("60000.00", "02:00:00", True, 85, "HIGH_AMOUNT_NIGHT"),
    ("40000.00", "12:00:00", True, 40, "ROUND_AMOUNT"),
    ("40000.01", "12:00:00", True, 65, "INTERNATIONAL_HIGH_AMOUNT"),
])
def test_static_rules(spark, amount, time, abroad, score, reason):
    row = silver.score(rows(spark, dict(
        amount_php=amount, event_timestamp=f"2024-01-15 {time}", is_international=abroad,
    ))).first()
    assert (row.fraud_score, row.fraud_reason) == (Decimal(score), reason)
    assert row.fraud_flag is (score >= 60)


def test_bands(spark):
    scores = spark.createDataFrame([("60",), ("59.99",), ("40",), ("39.99",), ("0",)], "s string")
    bands = scores.selectExpr("cast(s as decimal(5,2)) fraud_score").select(fraud.band().alias("b")).collect()
    assert [r.b for r in bands] == ["AUTO_FLAG", "MONITOR", "MONITOR", "NORMAL", "NORMAL"]


def test_alert_ids_are_repeatable_and_distinct(spark):
    scored = silver.score(rows(spark, *[dict(amount_php="60000.00", event_timestamp="2024-01-15 01:00:00")] * 3))
    first = [r.alert_id for r in fraud.alerts(scored).collect()]
    assert first == [r.alert_id for r in fraud.alerts(scored).collect()]
    assert len(set(first)) == 3
