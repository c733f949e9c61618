"""A large load shuffles ids and what rules look at; whole rows pass as they are."""

import pytest
from make import payload, rows

from kwarta.config import DEFAULT_RULES
from kwarta.operators import history
from kwarta.plans import load, silver
from kwarta.sinks import tables
from registry import fixture as fx


@pytest.fixture
def many(monkeypatch):
    """Every load is too large for its keys to be listed."""
    monkeypatch.setattr(load, "LISTED", 3)


def _raw(spark, ids, **fields):
    return spark.createDataFrame([(payload(event_id=i, user_id=f"u{n % 4}", **fields),) for n, i in enumerate(ids)], "value string")


def _stored(spark, lake):
    return sorted(r.transaction_id for r in tables.read(spark, lake.facts).collect())


@pytest.mark.parametrize("past", [False, True])
def test_large_load_of_new_events_looks_at_no_whole_rows(spark, lake, many, monkeypatch, past):
    monkeypatch.setattr(load, "unseen", lambda *a, **k: pytest.fail("whole rows were shuffled by id"))
    monkeypatch.setattr(load, "score_with_history", lambda *a, **k: pytest.fail("whole rows went through the timeline"))
    ids = [f"e{n}" for n in range(9)]
    for _ in range(2):
        assert load.load_batch(_raw(spark, ids), lake, "one", history=past).accepted == 9
    assert _stored(spark, lake) == ids
    assert len([n for n in tables.names_in(spark, lake.users) if n.startswith("part-")]) <= 2  # one is the empty table's


def test_large_load_drops_what_is_repeated_or_known(spark, lake, many):
    load.load_batch(_raw(spark, ["a", "b", "c", "d"]), lake, "one")
    assert load.load_batch(_raw(spark, ["a", "e", "e", "f", "g", "g"]), lake, "two").accepted == 3
    assert load.load_batch(_raw(spark, ["a", "e", "e", "f", "g", "g"]), lake, "two").accepted == 3
    assert _stored(spark, lake) == ["a", "b", "c", "d", "e", "f", "g"]


def test_irregular_ids_are_all_that_unseen_needs(spark, lake, many):
    load.load_batch(_raw(spark, ["a", "b", "c", "d"]), lake, "one")
    load.load_batch(_raw(spark, ["p", "q", "r", "s"]), lake, "two")
    valid = silver.valid(silver.cleanse(silver.parse(
        _raw(spark, ["a", "n", "n", "p", "q", "z"]).unionByName(_raw(spark, ["q", "r"], event_timestamp="2024-01-20T10:00:00Z")))))
    among = load.irregular(valid, lake, "two")
    assert sorted(r.event_id for r in among.collect()) == ["a", "n", "q", "r"]  # p is this load's own, of the same day
    found = [load.unseen(valid, lake, "two", among=some).select("event_id", "event_timestamp").collect() for some in (None, among)]
    assert sorted(found[0]) == sorted(found[1]) and sorted(r.event_id for r in found[0]) == ["n", "p", "q", "z"]


@pytest.mark.parametrize("hint", ["broadcast", "shuffle_hash"])
def test_scores_by_hits_are_those_of_whole_rows(spark, hint):
    df = rows(spark, *[
        dict(event_id=f"e{n}", user_id=f"u{n % 3}", amount_php=60000 if n % 5 == 0 else 101, is_international=n % 7 == 0,
             province=["Metro Manila", "Cebu", None][n % 2 if n % 11 else 2], event_timestamp=f"2024-01-15 12:00:{n:02d}")
        for n in range(40)])
    columns = ["event_id", "fraud_reason", "fraud_score", "fraud_flag"]
    whole = history.score_with_history(df, DEFAULT_RULES)
    hits = history.history_hits(df, DEFAULT_RULES)
    assert hits.columns == ["event_id", "past_reason"] and hits.count()
    assert sorted(map(str, history.score_with_hits(df, hits.hint(hint)).select(columns).collect())) == sorted(map(str, whole.select(columns).collect()))

def test_spans_are_dealt_by_id_without_a_sort(spark, monkeypatch):
    dealt, frame = [], type(spark.range(1))
    repartition = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda df, *by: dealt.append(by) or repartition(df, *by))
    fx.landed_in_order(spark, "/root/testdata/sf0.001", [fx.datetime(2024, 1, 15)])
    assert dealt == [(fx.SPAN_FILES, "event_id")] * 2  # a round robin sorts whole rows first
