import random
from datetime import timedelta

import pytest
from make import rows, ts
from pyspark.sql import functions as F

from kwarta.config import Rules
from kwarta.functions import geo
from kwarta.operators import history

NOON = ts("2024-01-15 12:00:00")


def at(seconds):
    return NOON + timedelta(seconds=seconds)


def counts(spark, seconds, **kw):
    df = rows(spark, *[dict(event_timestamp=at(s)) for s in seconds])
    found = history.recent_activity(df, **kw).orderBy("event_id").collect()
    return [r.tx_in_window for r in found]


def test_eleven_in_five_minutes_trip_and_ten_do_not(spark):
    ten = counts(spark, range(0, 300, 30))
    assert ten == list(range(1, 11))
    eleven = counts(spark, [*range(0, 300, 30), 300])
    assert eleven[-1] == 11 > Rules().velocity_count
    assert counts(spark, [*range(0, 300, 30), 301])[-1] == 10


def test_rows_of_one_instant_count_each_other(spark):
    assert counts(spark, [0, 0, 0]) == [3, 3, 3]


def test_count_crosses_slots(spark):
    # Slots start on the half hour: these rows straddle 12:30.
    assert counts(spark, [1700, 1799, 1800, 1999, 2000, 2001]) == [1, 2, 3, 4, 5, 5]
    # Exactly on the edge: a row leaves the window at the moment the next slot starts.
    assert counts(spark, [1500, 1800]) == [1, 2]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force_with_a_hot_user(spark, seed):
    rnd = random.Random(seed)
    rules = Rules(velocity_window=timedelta(minutes=5), jump_window=timedelta(minutes=10))
    places = ["Cebu", "Metro Manila", "Rizal", "Nowhere", None]
    records = []
    for n in range(600):
        user = "hot" if n % 3 == 0 else f"u{rnd.randrange(20)}"
        records.append(dict(
            user_id=user, event_id=f"e{n:04d}", province=rnd.choice(places),
            event_timestamp=at(rnd.randrange(4000) if user == "hot" else rnd.randrange(7200)),
        ))
    df = rows(spark, *records)
    place = geo.latitude(F.col("province")), geo.longitude(F.col("province"))
    got = {r.event_id: r for r in history.recent_activity(df, rules, place=place).collect()}
    assert len(got) == len(records)
    by_user = {}
    for r in records:
        by_user.setdefault(r["user_id"], []).append(r)
    for mine in by_user.values():
        mine.sort(key=lambda r: (r["event_timestamp"], r["event_id"]))
        for i, r in enumerate(mine):
            now = r["event_timestamp"]
            near = [o for o in mine if now - timedelta(minutes=5) <= o["event_timestamp"] <= now]
            assert got[r["event_id"]].tx_in_window == len(near)
            gap = (now - mine[i - 1]["event_timestamp"]) // timedelta(microseconds=1) if i else None
            expected = gap if gap is not None and gap <= 600_000_000 else None
            assert got[r["event_id"]].since_prev_us == expected


def jumps(spark, *records):
    df = history.with_history(rows(spark, *records)).orderBy("event_id")
    return [r.location_hit for r in df.collect()]


def test_location_jump(spark):
    manila, cebu = "Metro Manila", "Cebu"
    assert jumps(spark, dict(province=manila), dict(province=cebu, event_timestamp=at(600))) == [False, True]
    assert jumps(spark, dict(province=manila), dict(province=cebu, event_timestamp=at(601))) == [False, False]
    assert jumps(spark, dict(province=manila), dict(province="Rizal", event_timestamp=at(60))) == [False, False]
    assert jumps(spark, dict(province=manila), dict(province="Atlantis", event_timestamp=at(60))) == [False, False]
    # The slot ends between the two.
    assert jumps(
        spark, dict(province=manila, event_timestamp=at(1790)), dict(province=cebu, event_timestamp=at(1810))
    ) == [False, True]


def test_distance_limit_is_strict(spark):
    lat, lon = F.col("lat"), F.lit(0.0)
    for degrees, hit in ((0.899, False), (0.9, True)):  # 99.96 km and 100.08 km
        df = rows(spark, dict(), dict(event_timestamp=at(60))).withColumn(
            "lat", F.when(F.col("event_id") == "e0001", degrees).otherwise(0.0)
        )
        marked = history.with_history(df, place=(lat, lon)).filter("event_id = 'e0001'").first()
        assert marked.location_hit is hit


@pytest.mark.parametrize("gap, amount, hit", [
    (timedelta(days=180), "20000.00", True),
    (timedelta(days=180) - timedelta(microseconds=1), "20000.00", False),
    (timedelta(days=400), "20000.00", True),
    (timedelta(days=180), "19999.99", False),
])
def test_dormant(spark, gap, amount, hit):
    df = rows(spark, dict(amount_php="50000.00"), dict(amount_php=amount, event_timestamp=NOON + gap))
    found = [r.event_id for r in history.dormant_hits(df).collect()]
    assert found == (["e0001"] if hit else [])


def test_only_the_first_row_after_the_silence_is_dormant(spark):
    later = NOON + timedelta(days=200)
    df = rows(spark, dict(), *[dict(amount_php="25000.50", event_timestamp=later)] * 2)
    assert [r.event_id for r in history.dormant_hits(df).collect()] == ["e0001"]


def test_precedence(spark):
    far = [dict(province="Cebu" if n % 2 else "Palawan", event_timestamp=at(n)) for n in range(12)]
    df = history.score_with_history(rows(spark, *far, dict(
        province="Benguet", amount_php="11000.00", event_timestamp=at(12),
    )))
    reasons = [r.fraud_reason for r in df.orderBy("event_id").collect()]
    assert reasons == [None, *["LOCATION_JUMP"] * 9, *["VELOCITY_SPIKE"] * 2, "ROUND_AMOUNT"]


def test_slot_must_not_exceed_the_dormancy_gap(spark):
    with pytest.raises(ValueError):
        history.with_history(rows(spark, dict()), Rules(dormant_gap=timedelta(minutes=5)))
