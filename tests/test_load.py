from datetime import date, datetime
from glob import glob

from make import rows
from pyspark.sql import functions as F

from kwarta.operators import keyed
from kwarta.plans import load, marts, silver
from kwarta.sinks import segments, tables
from make import payload


def scored(spark, *records):
    return silver.score(rows(spark, *records))


def test_first_row_of_a_key_describes_it(spark):
    df = scored(
        spark,
        dict(province="Later", event_timestamp="2024-01-15 13:00:00"),
        dict(province="First", event_timestamp="2024-01-15 11:00:00", event_id="b"),
        dict(province="Tied", event_timestamp="2024-01-15 11:00:00", event_id="c"),
        dict(user_id="u2", merchant_id=None),
    )
    users = {r.user_id: r for r in load.new_users(df).collect()}
    assert users["u1"].home_province == "First" and users["u1"].kyc_level == "Level1"
    assert set(users) == {"u1", "u2"}
    merchants = load.new_merchants(df).collect()
    assert [(m.merchant_id, m.province, m.risk_score) for m in merchants] == [("m1", "First", 0)]


def test_stored_members_are_left_alone(spark):
    df = scored(spark, dict(), dict(user_id="u2"))
    stored = load.new_users(scored(spark, dict()))
    assert [r.user_id for r in load.new_users(df, stored).collect()] == ["u2"]


def test_facts_need_both_dimensions(spark):
    df = scored(
        spark, dict(), dict(user_id="ghost"), dict(merchant_id="ghost"), dict(merchant_id=None),
        dict(user_id="ghost", merchant_id="ghost"),
    )
    known = scored(spark, dict())
    users, merchants = load.new_users(known), load.new_merchants(known)
    assert [r.transaction_id for r in load.facts(df, users, merchants).collect()] == ["e0000"]
    orphans = {r.transaction_id: r.orphan_reason for r in load.fact_orphans(df, users, merchants).collect()}
    assert orphans == {
        "e0001": "UNKNOWN_USER", "e0002": "UNKNOWN_MERCHANT", "e0003": "NO_MERCHANT", "e0004": "UNKNOWN_USER",
    }


def state(spark, lake):
    names = [lake.users, lake.merchants, lake.facts, lake.alerts, lake.quarantine]
    return [sorted(map(repr, tables.read(spark, n).collect())) for n in names]


def test_loading_twice_changes_nothing(spark, lake):
    raw = spark.createDataFrame([
        (payload(event_id="a"),), (payload(event_id="a"),),
        (payload(event_id="b", amount_php=60000, event_timestamp="2024-01-14T01:00:00Z"),),
        (payload(event_id="c", amount_php=60000, event_timestamp="2024-01-14T01:00:00Z", merchant_id=None),),
        ("garbage",),
    ], "value string")
    load.load_batch(raw, lake, "one")
    once = state(spark, lake)
    assert [len(t) for t in once] == [1, 1, 2, 2, 1]
    load.load_batch(raw, lake, "one")
    again = state(spark, lake)
    assert once[:4] == again[:4] and len(again[4]) == 1
    days = {r.event_date for r in tables.read(spark, lake.facts).collect()}
    assert days == {date(2024, 1, 14), date(2024, 1, 15)}


def test_redelivery_in_a_later_load_is_ignored(spark, lake):
    first = spark.createDataFrame([(payload(event_id="a"),)], "value string")
    second = spark.createDataFrame([(payload(event_id="a"),), (payload(event_id="b"),)], "value string")
    load.load_batch(first, lake, "one")
    load.load_batch(second, lake, "two")
    assert sorted(r.transaction_id for r in tables.read(spark, lake.facts).collect()) == ["a", "b"]


def test_missing_tables_are_skipped(spark, tmp_path):
    from kwarta.config import Lake

    bare = Lake(str(tmp_path / "bare"))
    load.load_rows(rows(spark, dict()), bare, "one")
    assert not tables.exists(spark, bare.facts)


def test_history_rules_in_a_load(spark, lake):
    raw = spark.createDataFrame([
        (payload(event_id=f"e{n:02d}", event_timestamp=f"2024-01-15T12:00:{n:02d}Z"),) for n in range(12)
    ], "value string")
    load.load_batch(raw, lake, "one", history=True)
    alerts = tables.read(spark, lake.alerts).collect()
    assert sorted((a.transaction_id, a.alert_type) for a in alerts) == [
        ("e10", "VELOCITY_SPIKE"), ("e11", "VELOCITY_SPIKE"),
    ]


def test_lookup_keeps_rows_without_a_match(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), (None, 4)], "k string, n int")
    dim = spark.createDataFrame([("a", "x"), (None, "never")], "k string, name string")
    expected = [(1, "x"), (2, None), (3, None), (4, None)]
    assert sorted((r.n, r.name) for r in keyed.lookup(left, dim, "k", ["name"]).collect()) == expected


def burst(spark, start, stop):
    return spark.createDataFrame([
        (payload(event_id=f"e{n:02d}", event_timestamp=f"2024-01-15T12:00:{n:02d}Z"),) for n in range(start, stop)
    ], "value string")


def found(spark, lake):
    return sorted((a.transaction_id, a.alert_type) for a in tables.read(spark, lake.alerts).collect())


def test_history_rules_see_earlier_loads(spark, lake):
    load.load_batch(burst(spark, 0, 6), lake, "one", history=True)
    load.load_batch(burst(spark, 4, 12), lake, "two", history=True)  # two rows again: they do not count twice
    expected = [("e10", "VELOCITY_SPIKE"), ("e11", "VELOCITY_SPIKE")]
    assert found(spark, lake) == expected
    once = state(spark, lake)
    load.load_batch(burst(spark, 4, 12), lake, "two", history=True)
    assert state(spark, lake) == once
    old = spark.createDataFrame([(payload(event_id="late", event_timestamp="2024-08-15T12:00:00Z", amount_php=20001.5),)], "value string")
    load.load_batch(old, lake, "three", history=True)
    assert found(spark, lake) == [*expected, ("late", "DORMANT_REACTIVATION")]


def test_an_event_is_stored_once_whatever_its_batch_and_day(spark, lake):
    def sent(*records):
        return spark.createDataFrame([(payload(event_id=i, event_timestamp=f"2024-01-{day}T12:00:00Z"),) for i, day in records], "value string")

    load.load_batch(sent(("a", 15)), lake, "one")
    load.load_batch(sent(("a", 14)), lake, "alone")
    load.load_batch(sent(("a", 14), ("b", 15)), lake, "among")
    load.load_batch(sent(("a", 13)), lake, "one")
    facts = tables.read(spark, lake.facts).collect()
    assert sorted((r.transaction_id, r.event_date.day) for r in facts) == [("a", 15), ("b", 15)]


def test_a_crash_before_the_facts_is_repaired_by_the_same_load(spark, lake):
    df = rows(spark, dict(event_id="a"), dict(event_id="b", amount_php="60000.00", event_timestamp="2024-01-15 01:00:00"))
    load.remember(silver.score(df), lake, "one")  # the keys are stored, the facts are not
    load.load_rows(df, lake, "one")
    assert tables.read(spark, lake.facts).count() == 2 and len(found(spark, lake)) == 1
    load.load_rows(df, lake, "two")
    assert tables.read(spark, lake.facts).count() == 2 and len(found(spark, lake)) == 1


def test_quarantine_is_replaced_by_the_load_of_the_same_name(spark, lake):
    good, bad = spark.createDataFrame([(payload(),)], "value string"), spark.createDataFrame([("garbage",)], "value string")
    count = lambda: tables.read(spark, lake.quarantine).count()
    load.load_batch(good.union(bad), lake, "x/1")
    load.load_batch(bad, lake, "y")
    assert count() == 2
    yesterday = tables.read(spark, lake.quarantine).filter("load_id = 'y'").withColumn("arrival_date", F.date_sub("arrival_date", 1))
    load.load_quarantine(spark.createDataFrame(yesterday.collect(), yesterday.schema), lake, "y")
    load.load_batch(good, lake, "x/1")
    assert [(r.load_id, r.payload) for r in tables.read(spark, lake.quarantine).collect()] == [("y", "garbage")]
    load.load_batch(bad, lake, "y")
    assert count() == 1


def arriving(spark, day, *payloads):
    """Rejected rows that arrived on that day."""
    rows = [(p, "MALFORMED", datetime.fromisoformat(f"{day}T10:00:00"), date.fromisoformat(day)) for p in payloads]
    return spark.createDataFrame(rows, "payload string, reject_reason string, processing_timestamp timestamp, arrival_date date")


def test_a_replayed_micro_batch_adds_no_quarantine_whenever_it_arrived(spark, lake):
    for again in (False, True, True):
        load.load_quarantine(arriving(spark, "2024-01-12", "x", "x"), lake, "q-1", streamed=True, again=again)
    load.load_quarantine(arriving(spark, "2026-11-30", "x", "x"), lake, "q-1", streamed=True, again=True)  # read on another day
    load.load_quarantine(arriving(spark, "2024-01-12", "y"), lake, "q-2", streamed=True, again=True)
    assert sorted((r.load_id, r.payload) for r in tables.read(spark, lake.quarantine).collect()) == [("q-1", "x"), ("q-1", "x"), ("q-2", "y")]


def test_counts_come_from_the_writes(spark, lake):
    raw = spark.createDataFrame([
        (payload(event_id="a"),), (payload(event_id="a"),), ("garbage",), (payload(event_id="n", amount_php=60000, event_timestamp="2024-01-14T01:00:00Z"),),
    ], "value string")
    assert load.load_batch(raw, lake, "one") == load.Counts(accepted=2, flagged=1, rejected=1)
    assert load.load_batch(raw, lake, "two") == load.Counts(rejected=1)
    assert load.load_batch(raw.where("false"), lake, "none") == load.Counts()


def test_a_crash_before_the_dimensions_is_repaired_by_the_same_load(spark, lake):
    df = rows(spark, dict(event_id="a"), dict(event_id="b", user_id="u2", merchant_id="m2"))
    assert not load.begin(spark, lake, "one")
    load.remember(silver.score(df), lake, "one")
    segments.append(df.selectExpr("user_id", "'one' AS load_id"), lake.user_keys, load.load_group("one"))  # the rows are not stored
    load.load_rows(df, lake, "one")
    load.load_rows(df, lake, "one")
    load.load_rows(rows(spark, dict(event_id="c", user_id="u2")), lake, "two")
    assert sorted(r.user_id for r in tables.read(spark, lake.users).collect()) == ["u1", "u2"]
    assert sorted(r.merchant_id for r in tables.read(spark, lake.merchants).collect()) == ["m1", "m2"]
    assert tables.read(spark, lake.facts).count() == 3


def test_a_large_load_is_joined_with_all_keys(spark, lake, monkeypatch):
    monkeypatch.setattr(load, "LISTED", 3)
    load.load_batch(burst(spark, 0, 8), lake, "one", history=True)
    assert load.keys_in(rows(spark, *[{}] * 4)) is None
    load.load_batch(burst(spark, 4, 12), lake, "two", history=True)
    assert found(spark, lake) == [("e10", "VELOCITY_SPIKE"), ("e11", "VELOCITY_SPIKE")]
    assert tables.read(spark, lake.facts).count() == 12 and tables.read(spark, lake.users).count() == 1


def test_known_members_add_no_file_and_tables_can_be_compacted(spark, lake):
    for n in range(3):
        load.load_batch(spark.createDataFrame([(payload(event_id=f"e{n}"),)], "value string"), lake, f"l{n}")
    files = len(tables.read(spark, lake.users).inputFiles())
    load.load_batch(spark.createDataFrame([(payload(event_id="e3"),)], "value string"), lake, "l3")
    assert len(tables.read(spark, lake.users).inputFiles()) == files
    assert not glob(f"{lake.root}/_stage/*")
    before = state(spark, lake)
    assert segments.fold(spark, lake.event_keys, fan=2) == 1 and len(segments.segments(spark, lake.event_keys)) == 1
    tables.compact(spark, lake.facts, lake.table("_stage/facts"), "event_date", F.col("event_date") == "2024-01-15")
    assert len(tables.read(spark, lake.facts).inputFiles()) < 5
    assert state(spark, lake) == before and segments.read(spark, lake.event_keys).count() == 4


def test_the_latest_decision_counts(spark, lake):
    load.load_batch(burst(spark, 0, 11), lake, "one", history=True)
    alert = tables.read(spark, lake.alerts).first().alert_id
    for n, status in ((2, "CONFIRMED"), (1, "DISMISSED")):
        marts.triage(lake, spark.createDataFrame(
            [(alert, status, "ana", "n", datetime(2024, 1, 16, n)), (1, "CONFIRMED", "ana", "no such alert", None)], tables.BY_NAME["alert_decisions"]))
    assert [r.status for r in marts.alerts_now(lake, spark).collect()] == ["CONFIRMED"]
