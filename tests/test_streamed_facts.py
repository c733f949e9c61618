"""A large micro-batch is read in even splits, and its rows are judged once."""

import pytest
from make import payload
from pyspark.sql import functions as F

from kwarta.plans import load, silver
from kwarta.sinks import tables
from kwarta.sources import files
from kwarta.streaming import job

SPLITS = "spark.sql.files.minPartitionNum"


def _cleansed(spark, *sent):
    return silver.cleanse(silver.parse(spark.createDataFrame([(p,) for p in sent], "value string")))


@pytest.fixture
def no_number(spark):
    """The session has no number of splits of its own, as it had none before."""
    before = spark.conf.get(SPLITS, None)
    spark.conf.unset(SPLITS)
    yield
    spark.conf.unset(SPLITS) if before is None else spark.conf.set(SPLITS, before)


def _streamed_splits(spark, tmp_path, lake, monkeypatch, name):
    seen, run = [], job.load_micro_batch
    monkeypatch.setattr(job, "load_micro_batch", lambda batch, *a, **k: seen.append(batch.rdd.getNumPartitions()) or run(batch, *a, **k))
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    for n in range(24):
        (folder / f"part-{n}.txt").write_text(payload(event_id=f"e{n}") + "\n")
    job.start(files.stream_payloads(spark, str(folder)), lake, str(tmp_path / name), interval=None).awaitTermination()
    return seen


def test_files_of_a_micro_batch_are_dealt_in_splits_that_even_out(spark, tmp_path, lake, monkeypatch, no_number):
    cores = spark.sparkContext.defaultParallelism
    found = _streamed_splits(spark, tmp_path, lake, monkeypatch, "cp")
    assert len(found) == 1 and found[0] >= min(24, 2 * cores)  # about one per core before


def test_a_number_of_splits_of_the_session_stays(spark, tmp_path, lake, monkeypatch, no_number):
    spark.conf.set(SPLITS, "2")
    assert _streamed_splits(spark, tmp_path, lake, monkeypatch, "cp") == [2]
    assert spark.conf.get(SPLITS) == "2"


@pytest.mark.parametrize("listed", [3, 50_000])
def test_rules_look_at_the_rows_of_a_micro_batch_once(spark, lake, monkeypatch, listed):
    monkeypatch.setattr(load, "LISTED", listed)
    monkeypatch.setattr(silver, "score", lambda *a, **k: pytest.fail("cached rows were judged again"))
    sent = [payload(event_id=f"e{n}", user_id=f"u{n % 3}", amount_php=amount, is_international=n % 2 == 0)
            for n, amount in enumerate([100.5, 20000, 30500.5, 30500.5, 40000.5, 7])]
    expected = {"e1": ("ROUND_AMOUNT", 40, False), "e2": ("INTERNATIONAL_HIGH_AMOUNT", 65, True), "e4": ("INTERNATIONAL_HIGH_AMOUNT", 65, True)}
    for _ in range(2):
        counts = job.load_micro_batch(_cleansed(spark, *sent, "garbage"), "q-0", lake)
        assert (counts.accepted, counts.flagged) == (6, 2)
        facts = tables.read(spark, lake.facts).collect()
        assert len(facts) == 6
        assert {r.transaction_id: (r.fraud_reason, r.fraud_score, r.fraud_flag) for r in facts if r.fraud_reason} == expected
        assert sorted(r.transaction_id for r in tables.read(spark, lake.alerts).collect()) == ["e2", "e4"]


def test_of_rows_with_one_id_the_same_is_kept_judged_or_not(spark, lake):
    sent = [payload(event_id=f"e{n}", amount_php=amount) for n in range(12) for amount in (100.5, 20000, 60000.5)]
    rows = silver.valid(_cleansed(spark, *sent).withColumn("processing_timestamp", F.col("event_timestamp")))
    kept = [load.unseen(some, lake, "one").select("event_id", "amount_php") for some in (rows, silver.reasoned(rows))]
    assert sorted(kept[0].collect()) == sorted(kept[1].collect())
    assert silver.reasoned(rows).columns == [*rows.columns, "fraud_reason"]
