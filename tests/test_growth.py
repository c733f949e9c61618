"""Loads move whole rows no more often than they must."""

import pytest
from make import payload, rows

from kwarta.plans import load, silver
from kwarta.sinks import tables
from kwarta.streaming import job

SENT = [payload(event_id=f"e{n}", user_id=f"u{n % 3}", amount_php=60000.0 + n) for n in range(12)] + ["garbage"]


def _raw(spark):
    return spark.createDataFrame([(p,) for p in SENT], "value string")


@pytest.fixture
def many(monkeypatch):
    """Every load is too large for its keys to be listed."""
    monkeypatch.setattr(load, "LISTED", 3)


def test_large_load_sends_no_keys_to_one_task(spark, many, monkeypatch):
    frame = rows(spark, *[{}] * 4)
    assert len(load.keys_in(rows(spark, *[{}] * 3))["event_id"]) == 3
    monkeypatch.setattr(type(frame), "limit", lambda *a: pytest.fail("each task would send as many rows to a single one"))
    assert load.keys_in(frame) is None


def test_load_without_history_caches_no_whole_rows(spark, lake, many, monkeypatch):
    frame = _raw(spark)
    cached, persist = [], type(frame).persist
    monkeypatch.setattr(type(frame), "persist", lambda df, *a: cached.append(df.columns) or persist(df, *a))
    assert load.load_batch(frame, lake, "one").accepted == 12
    assert not [c for c in cached if "device_id" in c and "event_id" in c]


def test_repeated_load_compares_keys_and_writes_what_is_missing(spark, lake, many, monkeypatch):
    load.load_batch(_raw(spark), lake, "one")
    append, appended = tables.append, []
    monkeypatch.setattr(tables, "append", lambda df, path, *a: appended.append(path) or append(df, path, *a))
    load.load_batch(_raw(spark), lake, "one")
    assert lake.facts not in appended and lake.alerts not in appended
    tables.remove(spark, f"{lake.facts}/event_date=2024-01-15")
    load.load_batch(_raw(spark), lake, "one")
    assert appended.count(lake.facts) == 1 and lake.alerts not in appended
    assert sorted(r.transaction_id for r in tables.read(spark, lake.facts).collect()) == sorted(f"e{n}" for n in range(12))


def test_history_of_a_large_load_is_that_of_a_small_one(spark, tmp_path, monkeypatch):
    found = []
    for listed in (50_000, 3):
        monkeypatch.setattr(load, "LISTED", listed)
        lake = load.Lake(str(tmp_path / str(listed)))
        load.create_tables(spark, lake)
        for n in range(3):
            sent = [payload(event_id=f"{n}-{k}", user_id=f"u{k % 2}", amount_php=100.0,
                            event_timestamp=f"2024-01-15T12:0{n}:{k:02d}Z") for k in range(8)]
            load.load_batch(spark.createDataFrame([(p,) for p in sent], "value string"), lake, f"l{n}", history=True)
        stored = tables.read(spark, lake.facts).select("transaction_id", "fraud_reason").collect()
        found.append(sorted((r.transaction_id, r.fraud_reason or "") for r in stored))
        assert not tables.names_in(spark, lake.table("_stage"))
    assert len(found[0]) == 24 and any(reason for _, reason in found[0]) and found[0] == found[1]


def test_micro_batch_caches_the_payload_of_rejected_rows_alone(spark, lake, monkeypatch):
    kept, valid = [], silver.valid
    monkeypatch.setattr(job.silver, "valid", lambda df: kept.append(df.filter("payload IS NOT NULL").count()) or valid(df))
    job.load_micro_batch(silver.cleanse(silver.parse(_raw(spark))), "b-0", lake)
    assert kept == [1]
    assert [r.payload for r in tables.read(spark, lake.quarantine).collect()] == ["garbage"]
