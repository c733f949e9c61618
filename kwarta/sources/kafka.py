"""Kafka topics. Needs Spark's Kafka connector on the class path; the options are Spark's own."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Topic:
    servers: str
    name: str
    max_per_trigger: int = 30_000
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False

    def stream_options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.name,
            "startingOffsets": self.starting_offsets,
            "maxOffsetsPerTrigger": str(self.max_per_trigger),
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }

    def batch_options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.name,
            "startingOffsets": "earliest",
            "endingOffsets": "latest",
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }

    def sink_options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers,
            "topic": self.name,
            "kafka.acks": "all",
            "kafka.retries": "3",
            "kafka.compression.type": "gzip",
        }


def read_stream(spark: SparkSession, topic: Topic) -> DataFrame:
    """An unbounded table whose ``value`` holds one JSON payload per row."""
    return spark.readStream.format("kafka").options(**topic.stream_options()).load()


def read_batch(spark: SparkSession, topic: Topic) -> DataFrame:
    """What the topic retains now."""
    return spark.read.format("kafka").options(**topic.batch_options()).load()


def write_batch(payloads: DataFrame, topic: Topic, key: str | None = None) -> None:
    columns = [F.col("value")] if key is None else [F.col(key).cast("string").alias("key"), F.col("value")]
    payloads.select(*columns).write.format("kafka").options(**topic.sink_options()).save()


def write_stream(payloads: DataFrame, topic: Topic, checkpoint: str):
    writer = payloads.select("value").writeStream.format("kafka").options(**topic.sink_options())
    return writer.option("checkpointLocation", checkpoint).start()
