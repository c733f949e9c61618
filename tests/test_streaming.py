import os
import random
from datetime import timedelta

from make import payload, ts

from kwarta.config import Lake, Rules
from kwarta.plans import load, silver
from kwarta.sinks import tables
from kwarta.sources import files
from kwarta.streaming import job, windows

START = ts("2024-01-15 11:50:00")


def drop(folder, batch, payloads):
    folder.mkdir(exist_ok=True)
    file = folder / f"part-{batch}.txt"
    file.write_text("\n".join(payloads) + "\n")
    os.utime(file, (1_700_000_000 + batch,) * 2)  # files are taken in the order of their times


def some_payloads(seed, n=120, users=6):
    """In time order, so that batch and stream see every user's rows alike."""
    rnd, now, out = random.Random(seed), START, []
    for i in range(n):
        now += timedelta(seconds=rnd.randrange(0, 25))
        user = "hot" if i % 3 == 0 else f"u{rnd.randrange(users)}"
        out.append(payload(
            event_id=f"e{i:04d}", user_id=user, event_timestamp=now.isoformat() + "Z",
            amount_php=rnd.choice([100.5, 20000.0, 30500.5, 60000.5]),
            province=rnd.choice(["Cebu", "Palawan", "Rizal", "Nowhere"]),
            is_international=rnd.random() < 0.3, merchant_id=rnd.choice(["m1", "m2", None]),
        ))
    return out


def contents(spark, lake):
    """What the tables hold, without the wall clock."""
    facts = tables.read(spark, lake.facts).drop("processing_timestamp")
    alerts = tables.read(spark, lake.alerts).drop("created_at")
    users = tables.read(spark, lake.users).select("user_id", "home_province")
    return [sorted(map(repr, t.collect())) for t in (facts, alerts, users)]


def run(spark, folder, lake, checkpoint, **kw):
    stream = files.stream_payloads(spark, str(folder), files_per_trigger=1)
    job.start(stream, lake, str(checkpoint), interval=None, **kw).awaitTermination()


def test_stream_equals_batch_over_several_micro_batches(spark, tmp_path, lake):
    sent = some_payloads(1)
    dropped = tmp_path / "in"
    for n in range(3):
        drop(dropped, n, [*sent[n * 40:(n + 1) * 40], f"garbage {n}", sent[n * 40]])
    run(spark, dropped, lake, tmp_path / "cp")

    batch = Lake(str(tmp_path / "batch"))
    load.create_tables(spark, batch)
    load.load_batch(spark.read.text(str(dropped)), batch, "all")
    assert contents(spark, lake) == contents(spark, batch)
    bad = tables.read(spark, lake.quarantine).collect()
    assert sorted(r.payload for r in bad) == ["garbage 0", "garbage 1", "garbage 2"]

    # Starting over from an empty checkpoint replays everything: nothing is added.
    before = contents(spark, lake)
    run(spark, dropped, lake, tmp_path / "cp2")
    assert contents(spark, lake) == before


def test_history_on_a_stream_equals_batch(spark, tmp_path, lake):
    rules = Rules(velocity_count=3, dormant_gap=timedelta(minutes=31))
    sent = some_payloads(2, n=150, users=4)
    dropped = tmp_path / "in"
    for n in range(3):
        again = [sent[n * 50 + 7], *([sent[n * 50 - 1]] if n else [])]  # redelivered
        drop(dropped, n, [*sent[n * 50:(n + 1) * 50], "garbage", *again])
    run(spark, dropped, lake, tmp_path / "cp", history=True, rules=rules)

    batch = Lake(str(tmp_path / "batch"))
    load.create_tables(spark, batch)
    load.load_batch(spark.read.text(str(dropped)), batch, "all", rules, history=True)
    streamed, loaded = contents(spark, lake), contents(spark, batch)
    assert streamed == loaded
    reasons = {r.alert_type for r in tables.read(spark, lake.alerts).collect()}
    assert {"VELOCITY_SPIKE", "LOCATION_JUMP"} <= reasons
    assert tables.read(spark, lake.quarantine).count() == 3


def test_restart_from_the_same_checkpoint(spark, tmp_path, lake):
    """Each start goes on where the last has stopped, on a timed trigger too."""
    sent, dropped = some_payloads(5, 60), tmp_path / "in"
    for n in range(2):
        drop(dropped, n, sent[n * 30:(n + 1) * 30])
        stream = files.stream_payloads(spark, str(dropped), files_per_trigger=1)
        query = job.start(stream, lake, str(tmp_path / "cp"), interval="1 second")
        query.processAllAvailable()
        batches = [p["batchId"] for p in query.recentProgress if p["numInputRows"]]
        query.stop()
        assert batches == [n]
    batch = Lake(str(tmp_path / "batch"))
    load.create_tables(spark, batch)
    load.load_batch(spark.read.text(str(dropped)), batch, "all")
    assert contents(spark, lake) == contents(spark, batch)


def test_micro_batch_replay_is_a_no_op(spark, lake):
    raw = spark.createDataFrame([(p,) for p in some_payloads(3, 30)] + [("garbage",)], "value string")
    cleansed = silver.cleanse(silver.parse(raw))
    job.load_micro_batch(cleansed, "q-0", lake)
    once = contents(spark, lake)
    job.load_micro_batch(cleansed, "q-0", lake)
    assert contents(spark, lake) == once
    assert tables.read(spark, lake.quarantine).count() == 1


def to_table(stream, folder, spark):
    stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/cp").option(
        "path", f"{folder}/out").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def test_redelivery_and_closed_windows(spark, tmp_path):
    times = ["10:00:00", "10:30:00", "11:00:00", "11:20:00"]
    sent = [payload(event_id=f"e{n}", event_timestamp=f"2024-01-15T{t}Z") for n, t in enumerate(times)]
    drop(tmp_path / "in", 0, sent)
    drop(tmp_path / "in", 1, sent[2:])
    stream = files.stream_payloads(spark, str(tmp_path / "in"), 1)
    scored = silver.score(silver.valid(silver.cleanse(silver.parse(stream))))
    once = windows.unique_events(scored, "2 hours").select("event_id")
    assert sorted(r.event_id for r in to_table(once, tmp_path / "u", spark).collect()) == ["e0", "e1", "e2", "e3"]
    hours = to_table(windows.hourly_metrics(scored), tmp_path / "h", spark).collect()
    assert [(str(h.window_hour), h.transaction_count) for h in hours] == [("2024-01-15 10:00:00", 2)]
