"""Late facts, notes of arrivals, sketches and daily profiles."""

import re
from datetime import date, datetime, timedelta

import pytest
from make import payload
from pyspark.sql import functions as F

from kwarta.plans import load, marts, quality, reports
from kwarta.sinks import arrivals, tables

AS_OF = datetime(2024, 1, 20, 8)
MARTS = ("user_daily", "merchant_daily", "hourly")


def sent(spark, *records):
    """Payloads of (id, day, hour, merchant, amount)."""
    return spark.createDataFrame([
        (payload(event_id=i, event_timestamp=f"2024-01-{day:02d}T{hour:02d}:00:00Z", merchant_id=m, user_id=f"u{hash(i) % 3}", amount_php=a),)
        for i, day, hour, m, a in records], "value string")


FIRST = [(f"f{n}", 10 + n % 6, n % 24, f"m{n % 2}", 100.0 + n) for n in range(36)]
LATE = [("l1", 11, 5, "m0", 7000.5), ("l2", 11, 23, "m9", 1.0), ("l3", 20, 7, "m0", 5.0)]


def contents(spark, lake):
    return {name: sorted(map(repr, tables.read(spark, getattr(lake, name)).drop("created_at", "avg_processing_ms").collect())) for name in MARTS}


def files(spark, path, day):
    return {f for f in tables.read(spark, path).inputFiles() if f"={day}" in f}


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    """A lake that was refreshed between two loads, and one that was built in one go."""
    from kwarta.config import Lake

    lakes = []
    for parts in ([FIRST, LATE], [[*FIRST, *LATE]]):
        lake = Lake(str(tmp_path_factory.mktemp("lake") / "lake"))
        load.create_tables(spark, lake)
        seen = []
        for n, part in enumerate(parts):
            load.load_batch(sent(spark, *part), lake, f"load{n}")
            seen.append((marts.refresh(lake, spark, AS_OF), files(spark, lake.user_daily, "2024-01-13"), files(spark, lake.user_daily, "2024-01-11")))
        lakes.append((lake, seen))
    return lakes


def test_late_facts_reach_the_marts(spark, both):
    (late, _), (whole, _) = both
    assert contents(spark, late) == contents(spark, whole)
    growth = {(r.merchant_id, r.analysis_date.day): r.growth_vs_yesterday for r in tables.read(spark, late.merchant_daily).collect()}
    assert growth["m0", 12] < 0  # the day after the late fact stands on it


def test_only_touched_days_are_rewritten(spark, both):
    lake, seen = both[0]
    assert seen[0][0] == [date(2024, 1, d) for d in range(10, 16)]
    assert seen[1][0] == [date(2024, 1, 11)]
    assert seen[0][1] == seen[1][1] and seen[0][2] != seen[1][2]
    assert marts.refresh(lake, spark, AS_OF) == []
    assert list(marts.touched_days(lake, spark, datetime(2024, 1, 21))) == [date(2024, 1, 20)]  # still open at AS_OF


def test_a_note_made_meanwhile_stays(spark, tmp_path):
    from kwarta.config import Lake

    lake = Lake(str(tmp_path / "lake"))
    load.touch(spark, lake, [date(2024, 1, 11)], "one")
    seen = marts.touched_days(lake, spark, AS_OF)
    load.touch(spark, lake, [date(2024, 1, 11), date(2024, 1, 12)], "two")
    marts._settle(lake, spark, seen)
    assert {d: len(n) for d, n in marts.touched_days(lake, spark, AS_OF).items()} == {date(2024, 1, 11): 1, date(2024, 1, 12): 1}


def test_profiles_equal_scans(spark, both):
    lake, _ = both[0]
    facts, found = tables.read(spark, lake.facts), quality.profiled(lake, spark)
    required = ["transaction_id", "user_id", "fraud_reason"]
    limits = {c: n for c, n in tables.schemas.MAX_LENGTH["fact_transactions"].items()}
    expected = quality.constraints(facts, required, ["amount_php"]).unionByName(quality.lengths(facts, limits))
    assert sorted(map(repr, quality.profile_checks(found, required, ["amount_php"], limits).collect())) == sorted(map(repr, expected.collect()))
    columns = ["user_id", "fraud_reason", "province"]
    assert sorted(map(repr, quality.profile_completeness(found, columns).collect())) == sorted(map(repr, quality.completeness(facts, columns).collect()))


def test_profiles_scan_changed_days_only(spark, both):
    lake, _ = both[0]
    assert days_opened(quality.profiled(lake, spark), "amount_php") == {"2024-01-20"}


def test_sketches_add_up_over_days(spark, both):
    lake, _ = both[0]
    facts, sketches = tables.read(spark, lake.facts), tables.read(spark, lake.customers)
    for start, end in ((None, None), (date(2024, 1, 11), date(2024, 1, 13)), (date(2024, 1, 15), date(2024, 1, 15))):
        some = facts.filter(F.col("event_date").between(start or date(2000, 1, 1), end or date(2024, 1, 19)))
        exact = {r.merchant_id: r.n for r in some.groupBy("merchant_id").agg(F.countDistinct("user_id").alias("n")).collect()}
        assert {r.merchant_id: r.customers for r in marts.approximate_customers(sketches, start, end).collect()} == exact


def days_opened(frame, column):
    """The days that the scans of a table with that column are pruned to."""
    text = frame._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.split("\n") if "FileScan parquet" in line and column in line]
    assert scans and all("event_date" in re.search(r"PartitionFilters: \[(.*?)\]", s)[1] for s in scans)
    return set(re.findall(r"2024-\d\d-\d\d", " ".join(re.search(r"PartitionFilters: \[(.*?)\]", s)[1] for s in scans)))


def big(spark, load_id, lake, day, n):
    """A load of n flagged events of a day."""
    rows = [(payload(event_id=f"{load_id}-{k}", event_timestamp=f"2024-01-{day:02d}T01:00:{k:02d}Z", amount_php=60000.5),) for k in range(n)]
    return load.load_batch(spark.createDataFrame(rows, "value string"), lake, load_id)


def test_newest_alerts_open_the_newest_loads_only(spark, lake):
    for n, day in enumerate((10, 18, 12)):
        assert big(spark, f"l{n}", lake, day, 3).flagged == 3
    load.load_batch(sent(spark, ("calm", 14, 3, "m0", 5.5)), lake, "calm")
    assert [a.alerts for a in arrivals.newest(spark, lake)] == [0, 3, 3, 3]
    users, merchants = tables.read(spark, lake.users), tables.read(spark, lake.merchants)
    every = marts.alerts_now(lake, spark)
    for limit, days in ((2, {"2024-01-12"}), (4, {"2024-01-12", "2024-01-18"}), (99, None)):
        some = marts.alerts_now(lake, spark, newest_open=limit)
        assert days is None or days_opened(some, "alert_type") == days
        assert reports.fraud_alerts(some, users, merchants, limit).collect() == reports.fraud_alerts(every, users, merchants, limit).collect()
    alert = every.filter("transaction_id LIKE 'l2%'").select("alert_id")
    closed = alert.selectExpr("alert_id", "'CLOSED' status", "'ana' investigated_by", "'' notes", "current_timestamp() resolved_at")
    marts.triage(lake, closed)  # the newest load has no open alert left, so an older one is opened as well
    shown = reports.fraud_alerts(marts.alerts_now(lake, spark, newest_open=2), users, merchants, 2).collect()
    assert [r.transaction_id[:2] for r in shown] == ["l1", "l1"]


def test_freshness_opens_the_days_of_recent_loads_only(spark, lake):
    load.load_batch(sent(spark, ("a", 10, 3, "m0", 5.5), ("b", 14, 3, "m0", 5.5)), lake, "one")
    load.load_batch(sent(spark, ("c", 12, 3, "m0", 5.5)), lake, "two")
    now = datetime.now()
    begun = next(arrivals.newest(spark, lake)).micros
    found = quality.stored_freshness(lake, spark, now + timedelta(seconds=1), timedelta(hours=1)).first()
    assert (found.actual, found.passed) == (3, True)
    only_last = quality.stored_freshness(lake, spark, now, now - datetime.fromtimestamp(begun / 1e6))
    assert days_opened(only_last, "processing_timestamp") == {"2024-01-12"}
    none = quality.stored_freshness(lake, spark, now + timedelta(days=2), timedelta(hours=1)).first()
    assert (none.actual, none.passed, none.last_arrival) == (0, False, None)
