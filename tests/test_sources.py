"""Kafka and JDBC connectors are not installed here: these tests cover the options only."""

from kwarta.sources import jdbc, kafka


def test_kafka_options():
    topic = kafka.Topic("broker:9092", "payments")
    assert topic.stream_options() == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "payments", "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "30000", "failOnDataLoss": "false",
    }
    assert topic.batch_options()["startingOffsets"] == "earliest"
    assert topic.sink_options()["topic"] == "payments" and topic.sink_options()["kafka.acks"] == "all"


def test_jdbc_options():
    db = jdbc.Database("jdbc:x", "drv", "me", "pw", {"stringtype": "unspecified"})
    split = jdbc.Split("id", "0", "100", 8)
    options = jdbc.read_options(db, "silver.dim_users", split)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8"
    assert options["stringtype"] == "unspecified" and options["dbtable"] == "silver.dim_users"
    assert jdbc.write_options(db, "t", 4)["numPartitions"] == "4"
