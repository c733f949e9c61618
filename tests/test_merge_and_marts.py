from datetime import date, datetime
from decimal import Decimal

import pytest
from make import rows, ts

from kwarta.operators.merge import merge_by_key, merge_rows
from kwarta.plans import load, marts, silver
from kwarta.sinks import tables

AS_OF = datetime(2024, 1, 16)


def table(spark, *records):
    return spark.createDataFrame(list(records), "k string, d date, a int, b int")


D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def test_merge_updates_inserts_and_keeps(spark):
    old = table(spark, ("same", D1, 1, 1), ("hit", D1, 2, 2), ("null", D1, 5, 5))
    new = table(spark, ("hit", D1, 20, 20), ("fresh", D1, 3, 3), ("null", D1, None, 6))
    whole = sorted(map(tuple, merge_rows(old, new, ["k", "d"]).collect()))
    assert whole == sorted([("same", D1, 1, 1), ("hit", D1, 20, 20), ("fresh", D1, 3, 3), ("null", D1, None, 6)])
    only_a = sorted(map(tuple, merge_rows(old, new, ["k", "d"], ["a"]).collect()))
    assert only_a == sorted([("same", D1, 1, 1), ("hit", D1, 20, 2), ("fresh", D1, 3, 3), ("null", D1, None, 5)])
    with pytest.raises(ValueError):
        merge_rows(old, new, ["k", "d"], ["nope"])


def test_stored_merge_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t" / "merged")
    merge_by_key(path, table(spark, ("x", D1, 1, 1), ("y", D2, 1, 1)), ["k", "d"], "d", [D1, D2])
    files = {f for f in spark.read.parquet(path).inputFiles() if "2024-01-01" in f}
    source = table(spark, ("y", D2, 9, 9), ("z", D2, 3, 3))
    for _ in range(2):
        merge_by_key(path, source, ["k", "d"], "d", [D2], ["a"])
        stored = spark.read.parquet(path)
        assert sorted((r.k, r.a, r.b) for r in stored.collect()) == [("x", 1, 1), ("y", 9, 1), ("z", 3, 3)]
        assert {f for f in stored.inputFiles() if "2024-01-01" in f} == files


def facts_of(spark, *records):
    df = silver.score(rows(spark, *records))
    return load.as_facts(df), load.new_merchants(df)


def test_user_mart_modes(spark):
    facts, merchants = facts_of(
        spark,
        dict(merchant_id="a", merchant_name="Zed", merchant_category="Food"),
        dict(merchant_id="b", merchant_name="Abe", merchant_category="Bills"),
        dict(merchant_id="c", merchant_name=None, merchant_category=None),
        dict(merchant_id="c", merchant_name=None, merchant_category=None),
        dict(merchant_id="c", merchant_name=None, merchant_category=None),
        dict(user_id="u2", merchant_id="c", merchant_name=None, merchant_category=None),
        # Two merchants of one name together outnumber the others.
        *[dict(user_id="u3", merchant_id=m, merchant_name=n, merchant_category="Food")
          for m, n in (("d", "Twin"), ("e", "Twin"), ("f", "Solo"))],
    )
    mart = {r.user_id: r for r in marts.user_daily(facts, merchants, AS_OF).collect()}
    assert (mart["u1"].top_category, mart["u1"].top_merchant) == ("Bills", "Abe")
    assert (mart["u1"].food_spend_php, mart["u1"].transaction_count) == (Decimal("100.00"), 5)
    assert (mart["u2"].top_category, mart["u2"].top_merchant) == (None, None)
    assert mart["u3"].top_merchant == "Twin"


def test_user_mart_covers_exactly_the_day_before(spark):
    facts, merchants = facts_of(
        spark, dict(event_timestamp="2024-01-14 23:59:59.999999"), dict(event_timestamp="2024-01-15 00:00:00"),
        dict(event_timestamp="2024-01-15 23:59:59.999999"), dict(event_timestamp="2024-01-16 00:00:00"),
    )
    assert marts.user_daily(facts, merchants, AS_OF).first().transaction_count == 2
    days = marts.user_daily(facts, merchants, AS_OF, days=2).orderBy("spend_date").collect()
    assert [(str(r.spend_date), r.transaction_count) for r in days] == [("2024-01-14", 1), ("2024-01-15", 2)]


def test_growth_needs_the_day_before(spark):
    facts, _ = facts_of(
        spark,
        dict(merchant_id="grew", amount_php="80", event_timestamp="2024-01-14 10:00:00"),
        dict(merchant_id="grew", amount_php="100", event_timestamp="2024-01-15 10:00:00"),
        dict(merchant_id="gap", amount_php="50", event_timestamp="2024-01-13 10:00:00"),
        dict(merchant_id="gap", amount_php="100", event_timestamp="2024-01-15 10:00:00"),
        dict(merchant_id="fell", amount_php="300", event_timestamp="2024-01-14 10:00:00"),
        dict(merchant_id="fell", amount_php="100", event_timestamp="2024-01-15 10:00:00"),
        dict(merchant_id="rose", amount_php="0.01", event_timestamp="2024-01-14 10:00:00"),
        dict(merchant_id="rose", amount_php="999999999999.99", event_timestamp="2024-01-15 10:00:00"),
    )
    facts = facts.filter("merchant_id <> 'rose'").unionByName(facts.filter("merchant_id = 'rose'"))
    growth = {r.merchant_id: r.growth_vs_yesterday for r in marts.merchant_growth(facts).collect()
              if str(r.analysis_date) == "2024-01-15"}
    assert growth["grew"] == Decimal("25.00") and growth["gap"] is None
    assert growth["fell"] == Decimal("-66.67")
    assert growth["rose"] == Decimal("9999999999999800.00")


def test_hourly_mart_runs_through_now(spark):
    facts, _ = facts_of(
        spark, dict(event_timestamp="2024-01-14 23:59:59"), dict(event_timestamp="2024-01-15 00:10:00"),
        dict(event_timestamp="2024-01-16 09:59:00"), dict(event_timestamp="2024-01-16 10:30:00"),
    )
    hours = [str(r.window_hour) for r in marts.hourly(facts, ts("2024-01-16 10:00:00")).collect()]
    assert sorted(hours) == ["2024-01-15 00:00:00", "2024-01-16 09:00:00"]


def test_rebuilding_a_mart_changes_nothing(spark, lake):
    facts, merchants = facts_of(spark, dict(), dict(user_id="u2"), dict(event_timestamp="2024-01-14 10:00:00"))
    tables.append(tables.conform(facts, tables.BY_NAME["fact_transactions"]), lake.facts, "event_date")
    tables.append(tables.conform(merchants, tables.BY_NAME["dim_merchants"]), lake.merchants)
    seen = []
    for _ in range(2):
        marts.build_all(lake, spark, AS_OF)
        seen.append([
            sorted(map(repr, tables.read(spark, t).collect()))
            for t in (lake.user_daily, lake.merchant_daily, lake.hourly)
        ])
    assert seen[0] == seen[1]
    assert [len(t) for t in seen[0]] == [2, 1, 1]


def test_triage_updates_only_decided_alerts(spark, lake):
    big = dict(amount_php="60000", event_timestamp="2024-01-15 01:00:00")
    load.load_rows(rows(spark, big, big), lake, "one")
    target = tables.read(spark, lake.alerts).filter("transaction_id = 'e0001'").first()
    decisions = spark.createDataFrame(
        [(target.alert_id, "CLOSED", "ana", None, ts("2024-01-16 08:00:00")), (1, "CLOSED", "ana", None, None)],
        "alert_id bigint, status string, investigated_by string, notes string, resolved_at timestamp",
    )
    marts.triage(lake, decisions)
    after = {r.transaction_id: (r.status, r.investigated_by) for r in marts.alerts_now(lake, spark).collect()}
    assert after == {"e0000": ("NEW", None), "e0001": ("CLOSED", "ana")}
