"""Loads and marts read and shuffle their rows no more often than they must."""

from datetime import datetime

import pytest
from make import payload

from kwarta.plans import load, marts
from kwarta.sinks import tables
from registry import batch
from registry import fixture as fx

SMALL = "/root/testdata/sf0.001"


def test_user_mart_is_dealt_by_user_and_day_once(spark, lake):
    load.load_batch(spark.createDataFrame([(payload(),)], "value string"), lake, "one")
    facts, merchants = tables.read(spark, lake.facts), tables.read(spark, lake.merchants)
    plan = marts.user_daily(facts, merchants.hint("broadcast"), datetime(2024, 1, 16))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Expand" not in plan


def test_marts_of_a_refresh_are_built_together(spark, lake, monkeypatch):
    load.load_batch(spark.createDataFrame([(payload(),)], "value string"), lake, "one")
    started, run = [], marts.together
    monkeypatch.setattr(marts, "together", lambda s, *steps: started.append(len(steps)) or run(s, *steps))
    assert marts.refresh(lake, spark, datetime(2024, 1, 16)) and started == [5]


def test_late_events_are_landed_apart(spark, monkeypatch):
    sent, load_batch = [], load.load_batch
    monkeypatch.setattr(load, "load_batch", lambda rows, *a, **k: sent.append(rows.count()) or load_batch(rows, *a, **k))
    landed, read = [], fx.landed
    monkeypatch.setattr(fx, "landed", lambda rows: landed.append(rows) or read(rows))
    batch.marts_after_late_load(spark, SMALL)
    events = fx.table(spark, SMALL, "events")
    late = events.filter("event_id % 9 = 4").count()
    assert [spark.read.text(read(rows)).count() for rows in landed] == sent == [events.count() - late, late]


def _sent(spark, ids, **fields):
    return spark.createDataFrame([(payload(event_id=i, **fields),) for i in ids], "value string")


def test_large_load_of_known_events_compares_no_whole_rows(spark, lake, monkeypatch):
    monkeypatch.setattr(load, "LISTED", 3)
    assert load.load_batch(_sent(spark, "abcdef"), lake, "one").accepted == 6
    monkeypatch.setattr(load, "unseen", lambda *a, **k: pytest.fail("whole rows were shuffled by id"))
    assert load.load_batch(_sent(spark, "abcdef"), lake, "two").accepted == 0
    assert load.load_batch(_sent(spark, "aabcde"), lake, "three").accepted == 0  # repeated, but known
    assert load.load_batch(_sent(spark, "abcdefg"), lake, "four").accepted == 1
    moved = _sent(spark, "abcdeg", event_timestamp="2024-01-20T10:00:00Z")
    assert load.load_batch(moved, lake, "four").accepted == 0  # g is its own, of another day
    assert sorted(r.transaction_id for r in tables.read(spark, lake.facts).collect()) == list("abcdefg")
