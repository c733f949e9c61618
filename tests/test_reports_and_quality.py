from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from make import rows

from kwarta.config import Lake
from kwarta.operators import fraud
from kwarta.plans import load, quality, reports, silver

NOW = datetime(2024, 1, 15, 12)


def star(spark, *records):
    df = silver.score(rows(spark, *records))
    return load.as_facts(df), load.new_users(df), load.new_merchants(df)


def test_realtime_on_nothing_is_zero(spark):
    facts, *_ = star(spark, dict(event_timestamp="2024-01-10 00:00:00"))
    row = reports.realtime_stats(facts, NOW).first()
    assert (row.total_transactions, row.total_volume, row.active_users) == (0, 0, 0)
    assert row.success_rate == 0 and row.fraud_rate == 0 and row.avg_transaction is None


def test_realtime_bounds_are_inclusive(spark):
    facts, *_ = star(
        spark, dict(event_timestamp="2024-01-15 11:00:00"), dict(event_timestamp="2024-01-15 10:59:59.999999"),
        dict(event_timestamp="2024-01-15 12:00:00", status="FAILED"), dict(event_timestamp="2024-01-15 12:00:00.000001"),
    )
    row = reports.realtime_stats(facts, NOW).first()
    assert (row.total_transactions, row.success_count, row.success_rate) == (2, 1, Decimal("50.00"))


def test_live_feed_filters_after_the_limit(spark):
    big = dict(amount_php="60000", event_timestamp="2024-01-15 01:00:00")
    newer = [dict(event_timestamp="2024-01-15 11:00:00")] * 2
    facts, users, merchants = star(spark, big, *newer)
    assert reports.live_transactions(facts, users, merchants, 2).count() == 2
    assert reports.live_transactions(facts, users, merchants, 2, fraud_only=True).count() == 0
    flagged = reports.live_transactions(facts, users, merchants, 3, fraud_only=True).collect()
    assert [(r.transaction_id, r.user_name, r.merchant_name) for r in flagged] == [("e0000", "Ana", "Shop")]


def test_alert_report_keeps_alerts_without_a_merchant(spark):
    df = silver.score(rows(spark, dict(amount_php="60000", event_timestamp="2024-01-15 01:00:00", merchant_id=None)))
    alerts, users, merchants = fraud.alerts(df), load.new_users(df), load.new_merchants(df)
    for limit in (20, None):
        shown = reports.fraud_alerts(alerts, users, merchants, limit).collect()
        assert [(r.user_name, r.merchant_name, r.alert_type) for r in shown] == [("Ana", None, "HIGH_AMOUNT_NIGHT")]
    recent = reports.fraud_alerts(alerts, users, merchants, since=datetime(2999, 1, 1))
    assert recent.count() == 0


def test_merchants_of_one_name_are_added_up(spark):
    facts, _, merchants = star(
        spark, dict(merchant_id="a", event_timestamp="2024-01-15 11:00:00"),
        dict(merchant_id="b", event_timestamp="2024-01-15 11:00:00"),
        dict(merchant_id="c", merchant_name="Other", event_timestamp="2024-01-15 11:00:00"),
    )
    top = reports.top_merchants(facts, merchants, NOW, 1).collect()
    assert [(r.merchant_name, r.tx_count, r.total_volume) for r in top] == [("Shop", 2, Decimal("200.00"))]
    assert reports.category_breakdown(facts, merchants, NOW).first().tx_count == 3


def test_missing_channel_is_a_group(spark):
    facts, *_ = star(spark, dict(channel=None), dict(), dict())
    got = [(r.channel, r.tx_count) for r in reports.channel_distribution(facts, NOW).collect()]
    assert got == [("QR", 2), (None, 1)]


def verdicts(df):
    return {r.check: (r.actual, r.passed) for r in df.collect()}


def test_constraints_lengths_and_keys(spark):
    df = spark.createDataFrame(
        [("a", 1, "x" * 5), (None, 0, None), ("a", -1, "x")], "k string, amount int, note string"
    )
    assert verdicts(quality.constraints(df, ["k", "amount"], ["amount"])) == {
        "k is null": (1, False), "amount is null": (0, True), "amount not positive": (2, False),
    }
    assert verdicts(quality.lengths(df, {"note": 4})) == {"note longer than 4": (1, False)}
    assert verdicts(quality.unique_key(df, ["k"])) == {"repeated k": (1, False)}
    assert verdicts(quality.unique_key(df, ["k", "amount"])) == {"repeated k, amount": (0, True)}
    assert [(r.k, r.copies) for r in quality.repeated_keys(df, ["k"]).collect()] == [("a", 2)]


def test_references_and_completeness(spark):
    facts = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "user_id string")
    dim = spark.createDataFrame([("a",)], "user_id string")
    assert verdicts(quality.references(facts, {"user_id": dim})) == {"user_id without match": (2, False)}
    assert verdicts(quality.completeness(facts, ["user_id"])) == {"user_id": (Decimal("75.0000"), False)}


def test_freshness_and_samples(spark):
    facts, *_ = star(spark, dict(processing_timestamp=NOW - timedelta(minutes=10)), dict(processing_timestamp=NOW - timedelta(minutes=11)))
    row = quality.freshness(facts, NOW).first()
    assert (row.actual, row.passed, row.last_arrival) == (1, True, NOW - timedelta(minutes=10))
    assert verdicts(quality.has_messages(facts, 1)) == {"messages sampled": (1, True)}
    assert verdicts(quality.has_messages(facts.limit(0))) == {"messages sampled": (0, False)}


def test_table_checks(spark, lake, tmp_path):
    assert all(r.passed for r in quality.layers_complete(spark, lake).collect())
    bare = Lake(str(tmp_path / "none"))
    assert not any(r.passed for r in quality.layers_complete(spark, bare).collect())
    spark.range(1).createOrReplaceTempView("seen_table")
    assert verdicts(quality.tables_exist(spark, ["seen_table", "unseen_table"])) == {
        "seen_table": (1, True), "unseen_table": (0, False),
    }


@pytest.mark.parametrize("as_of, expected", [(datetime(2024, 1, 16), True), (datetime(2024, 1, 20), False)])
def test_mart_counts(spark, as_of, expected):
    from kwarta.plans import marts

    facts, _, merchants = star(spark, dict())
    built = datetime(2024, 1, 16)
    checks = quality.mart_counts(
        marts.user_daily(facts, merchants, built), marts.merchant_daily(facts, built), marts.hourly(facts, built), as_of
    ).collect()
    assert [r.passed for r in checks] == [expected] * 3
