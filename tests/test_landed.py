"""How the queries' payloads are landed."""

import json

from pyspark.sql import functions as F

from kwarta.sinks import tables
from registry import fixture as fx


def test_payloads_are_landed_without_a_shuffle_of_their_text(spark):
    folder = "/root/testdata/sf0.001"
    sent = fx.payloads(spark, folder)
    place = fx.landed(sent)
    assert all(n.endswith(".snappy") for n in tables.names_in(spark, place) if n.startswith("part-"))
    ids = spark.read.text(place).select(F.get_json_object("value", "$.event_id").cast("bigint").alias("i"))
    assert ids.agg(F.count("i"), F.count_distinct("i")).first()[:] == (fx.table(spark, folder, "events").count(),) * 2
    assert json.loads(spark.read.text(place).first().value)["event_id"]


def test_spans_land_in_the_same_number_of_files(spark):
    place = fx.landed_in_order(spark, "/root/testdata/sf0.001", [fx.datetime(2024, 1, d) for d in (7, 13, 19, 25)])
    parts = [n for n in tables.names_in(spark, place) if n.startswith("part-")]
    assert len(parts) == 5 * fx.SPAN_FILES and fx.SPAN_FILES > 4
