"""The redelivery query sends every payload again."""

from datetime import timedelta

from pyspark.sql import functions as F

from kwarta.plans import load
from registry import batch
from registry import fixture as fx

EVENTS, MERCHANTS = 60, 20


def _tables(spark, folder):
    spark.range(EVENTS).selectExpr(
        "id AS event_id", "timestamp_ntz '2024-01-10 12:00:00' + make_interval(0, 0, 0, cast(id % 9 AS int), 0, 0, id) AS ts",
        "id % 7 AS user_id", "'purchase' AS event_type", "1.5D + id AS value",
        f"concat('{{\"k\": ', 5 + id % {MERCHANTS}, '}}') AS props",
    ).write.parquet(f"{folder}/events.parquet")
    spark.range(7).selectExpr(
        "id AS c_custkey", "concat('C', id) AS c_name", "cast(id AS int) AS c_nationkey", "'SEG' AS c_mktsegment",
    ).write.parquet(f"{folder}/customer.parquet")
    spark.range(5, 5 + MERCHANTS).selectExpr(
        "id AS s_suppkey", "concat('S', id) AS s_name", "cast(id % 3 AS int) AS s_nationkey",
    ).write.parquet(f"{folder}/supplier.parquet")
    spark.range(3).selectExpr("cast(id AS int) AS n_nationkey", "concat('N', id) AS n_name").write.parquet(f"{folder}/nation.parquet")
    return str(folder)


def test_every_payload_is_sent_again_alone_and_among_all(spark, tmp_path, monkeypatch):
    folder, sent, load_batch = _tables(spark, tmp_path), {}, load.load_batch

    def watched(rows, lake, load_id, *a, **k):
        at = F.get_json_object("value", "$.event_timestamp").cast("timestamp")
        sent[load_id] = sorted(map(tuple, rows.select(F.get_json_object("value", "$.event_id").cast("int"), at.cast("date")).collect()))
        return load_batch(rows, lake, load_id, *a, **k)

    monkeypatch.setattr(load, "load_batch", watched)
    facts = batch.load_redelivery(spark, folder).select(F.col("transaction_id").cast("int"), "event_date").collect()
    first = {r.event_id: r.day for r in fx.table(spark, folder, "events").select("event_id", F.to_date("ts").alias("day")).collect()}
    moved = {i: day + timedelta(days=1) for i, day in first.items()}
    assert len(first) == EVENTS and sent["all"] == sorted(first.items())
    assert sent["alone"] == sorted(moved.items()) and sent["among"] == sorted([*moved.items(), *first.items()])
    assert sorted(map(tuple, facts)) == sorted(first.items())  # none twice, and none on another day
