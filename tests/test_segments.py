"""Keyed segments: searches against plain filters, folds, crashes, and how much a search reads."""

import random

import pytest
from make import payload
from pyspark.sql import functions as F

from kwarta.plans import load
from kwarta.sinks import segments, tables


@pytest.fixture
def keys(spark, tmp_path):
    path = str(tmp_path / "silver" / "event_keys")
    segments.create(spark, path)
    return path


def rows_of(spark, ids, load_id):
    frame = spark.createDataFrame([(i,) for i in ids], "transaction_id string") if isinstance(ids, list) else ids
    return frame.select("transaction_id", F.lit("2024-01-15").cast("date").alias("event_date"), F.lit(load_id).alias("load_id"))


def hashes(spark, ids):
    return [r[0] for r in spark.createDataFrame([(i,) for i in ids], "k string").select(F.xxhash64("k")).collect()]


def found(spark, path, ids):
    return sorted((r.transaction_id, r.load_id) for r in segments.lookup(spark, path, hashes(spark, ids)).collect() if r.transaction_id in ids)


def scanned(frame):
    """Rows that came out of the scans of a frame, once it has been collected."""
    frame.collect()
    plan, total = frame._jdf.queryExecution().executedPlan(), 0
    todo = [plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_searches_over_loads_and_folds(spark, keys):
    draw, stored = random.Random(4), {}
    for n in range(7):
        ids = [f"e{draw.randrange(10**6)}" for _ in range(50)]
        ids = [i for i in ids if i not in stored]
        stored |= dict.fromkeys(ids, f"l{n}")
        assert segments.append(rows_of(spark, ids, f"l{n}"), keys, f"l{n}", few=n % 2 == 0) == len(ids)
        segments.fold(spark, keys, fan=3)
        asked = [*draw.sample(sorted(stored), 20), "none", "e-1"]
        assert found(spark, keys, asked) == sorted((i, stored[i]) for i in asked if i in stored)
    assert {s.level for s in segments.segments(spark, keys)} == {0, 1}
    assert segments.read(spark, keys).count() == len(stored)
    known = segments.known_hashes(spark, keys, hashes(spark, [*list(stored)[:5], "none"]))
    assert sorted(known) == sorted(hashes(spark, list(stored)[:5]))
    assert segments.lookup(spark, keys, []).count() == 0


def test_nothing_stored(spark, keys):
    assert segments.segments(spark, keys) == [] and segments.read(spark, keys).count() == 0
    assert segments.append(rows_of(spark, [], "l"), keys, "l") == 0
    assert segments.segments(spark, keys) == [] and segments.fold(spark, keys, fan=1) == 0
    assert segments.lookup(spark, keys, [1, -(2**63), 2**63 - 1]).count() == 0


def test_only_finished_loads_are_folded(spark, keys):
    for n in range(4):
        segments.append(rows_of(spark, [f"e{n}"], f"l{n}"), keys, f"l-{n}", few=True)
    assert segments.fold(spark, keys, lambda load: load != "l-2", fan=4) == 0
    assert segments.fold(spark, keys, lambda load: load != "l-2", fan=3) == 1
    assert sorted(segments.load_of(s) for s in segments.segments(spark, keys) if s.level == 0) == ["l-2"]
    assert segments.read(spark, keys).count() == 4


def test_a_segment_without_its_entry_does_not_count(spark, keys):
    segments.append(rows_of(spark, ["a"], "one"), keys, "one", few=True)
    segments.append(rows_of(spark, ["b"], "two"), keys, "two", few=True)
    entry = next(s.name for s in segments.segments(spark, keys) if segments.load_of(s) == "two")
    tables.remove(spark, f"{keys}/_log/{entry}.json")  # as after a crash before the entry
    assert found(spark, keys, ["a", "b"]) == [("a", "one")]


def test_replaced_folders_go_with_the_next_fold(spark, keys, tmp_path):
    for n in range(2):
        segments.append(rows_of(spark, [f"e{n}"], "l"), keys, f"l{n}", few=True)
    reader = segments.read(spark, keys)
    assert segments.fold(spark, keys, fan=2) == 1
    assert reader.count() == 2  # a reader that began before the fold still finds its files
    assert len([n for n in tables.names_in(spark, keys) if n.startswith("l0-")]) == 2
    segments.fold(spark, keys, fan=2)
    assert [n for n in tables.names_in(spark, keys) if n != "_log"] == [s.name for s in segments.segments(spark, keys)]
    assert segments.read(spark, keys).count() == 2


def test_stretches_of_a_user_become_one(spark, tmp_path):
    path = str(tmp_path / "silver" / "user_stretches")
    segments.create(spark, path)
    for n, (first, last) in enumerate([(5, 9), (2, 3), (7, 20)]):
        one = spark.createDataFrame([("u", 1, first, last, f"l{n}"), ("v", n, 1, 1, f"l{n}")], "user_id string, stretch long, first_us long, last_us long, load_id string")
        segments.append(one, path, f"l{n}", few=True)
    segments.fold(spark, path, fan=3)
    rows = {(r.user_id, r.stretch): (r.first_us, r.last_us, r.load_id) for r in segments.read(spark, path).collect()}
    assert rows == {("u", 1): (2, 20, None), **{("v", n): (1, 1, None) for n in range(3)}}


def test_a_batch_reads_as_much_from_a_large_table_as_from_a_small_one(spark, keys, monkeypatch):
    """Two hundred new ids against 0.8 and 3.2 million stored ones: one page each at most, and no more files than needed."""
    monkeypatch.setattr(segments, "PAGE_ROWS", 100)
    monkeypatch.setattr(segments, "FILE_ROWS", 100_000)
    asked, read = hashes(spark, [f"new{n}" for n in range(200)]), []
    for part in range(4):
        ids = spark.range(part * 800_000, (part + 1) * 800_000).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("transaction_id"))
        segments.append(rows_of(spark, ids, f"l{part}"), keys, f"l{part}")
        segments.fold(spark, keys, fan=2)
        read.append(scanned(segments.lookup(spark, keys, asked, ["key_hash"])))
    current = segments.segments(spark, keys)
    assert sum(s.rows for s in current) == 3_200_000 and len(current) == 1
    assert 0 < read[-1] <= len(asked) * 2 * 100 < 3_200_000 // 50
    assert read[-1] <= 2 * read[0]
    few = hashes(spark, ["e7", "e3000000"])
    inputs = segments.lookup(spark, keys, few).inputFiles()
    assert len(inputs) <= 2 < sum(len(s.files) for s in current)
    assert found(spark, keys, ["e7", "e3000000"]) == [("e3000000", "l3"), ("e7", "l0")]


def test_micro_batches_read_no_more_as_the_lake_grows(spark, lake, monkeypatch):
    """Loads of other users: the segments that a load opens are bounded by the fan, not by the loads."""
    opened, plain = [], segments.lookup
    monkeypatch.setattr(segments, "FAN", 2)

    def counted(session, path, *args):
        opened.append((path, len(segments.segments(session, path))))
        return plain(session, path, *args)

    monkeypatch.setattr(segments, "lookup", counted)
    for n in range(6):
        raw = spark.createDataFrame([(payload(event_id=f"e{n}-{k}", user_id=f"u{n}", merchant_id=f"m{n}"),) for k in range(3)], "value string")
        load.load_batch(raw, lake, f"l{n}", history=True)
    assert max(n for path, n in opened if path == lake.event_keys) <= 2
    assert {path for path, _ in opened} == set(lake.segmented())
    assert tables.read(spark, lake.users).count() == 6 and tables.read(spark, lake.facts).count() == 18
