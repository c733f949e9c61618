"""Windowed aggregates on a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kwarta import schemas
from kwarta.config import Lake
from kwarta.functions import money
from kwarta.operators.merge import merge_by_key
from kwarta.sinks import tables


def unique_events(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop redelivered events that arrive within the watermark's delay of their first copy."""
    return events.withWatermark("event_timestamp", delay).dropDuplicatesWithinWatermark(["event_id"])


def hourly_metrics(scored: DataFrame, delay: str = "10 minutes", hour: str = "1 hour") -> DataFrame:
    """The hourly mart on a stream: an hour is emitted once the watermark has passed its end, and
    events that come later than that are dropped here (the fact table still takes them)."""
    n = F.count(F.lit(1))
    return (
        scored.withWatermark("event_timestamp", delay)
        .groupBy(F.window("event_timestamp", hour).alias("w"))
        .agg(
            n.alias("transaction_count"),
            F.sum("amount_php").cast("decimal(16,2)").alias("total_volume_php"),
            F.count_if(F.col("transaction_type") == "PAYMENT").alias("payment_count"),
            F.count_if(F.col("transaction_type") == "TRANSFER").alias("transfer_count"),
            F.count_if(F.col("transaction_type") == "CASHOUT").alias("cashout_count"),
            money.percent(F.count_if(F.col("status") == "SUCCESS"), n).alias("success_rate"),
            money.percent(F.count_if("fraud_flag"), n, "decimal(7,4)").alias("fraud_rate"),
            money.mean_delay_millis("event_timestamp", "processing_timestamp").alias("avg_processing_ms"),
        )
        .select(
            F.col("w.start").alias("window_hour"), "transaction_count", "total_volume_php",
            "payment_count", "transfer_count", "cashout_count", "success_rate", "fraud_rate", "avg_processing_ms",
        )
    )


def start_live_hours(
    scored: DataFrame, lake: Lake, checkpoint: str, delay: str = "10 minutes", interval: str | None = "10 seconds"
) -> StreamingQuery:
    """Keep the stored hourly mart up to date while its hours are still open.

    The stream holds one row of sums per open hour and emits the hours that a micro-batch has changed; they are
    merged by key into the partitions of their days. A replayed micro-batch writes the same rows again. What comes
    after the watermark has closed an hour is left to the nightly build and :func:`marts.refresh`. ``interval``
    None processes what there is and stops.
    """

    def upsert(changed: DataFrame, _: int) -> None:
        dated = changed.withColumns({"window_date": F.to_date("window_hour"), "created_at": F.current_timestamp()})
        rows = tables.conform(dated, schemas.HOURLY).persist()
        try:
            days = [d for (d,) in rows.select("window_date").distinct().collect()]
            if days:
                merge_by_key(lake.hourly, rows, ["window_hour"], "window_date", days)
        finally:
            rows.unpersist()

    writer = hourly_metrics(scored, delay).writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return writer.trigger(**({"availableNow": True} if interval is None else {"processingTime": interval})).start()


def velocity_windows(
    events: DataFrame,
    more_than: int = 10,
    width: str = "5 minutes",
    slide: str = "1 minute",
    delay: str = "10 minutes",
) -> DataFrame:
    """Users with more than so many transactions in a sliding window."""
    return (
        events.withWatermark("event_timestamp", delay)
        .groupBy("user_id", F.window("event_timestamp", width, slide).alias("w"))
        .agg(F.count(F.lit(1)).alias("tx_count"))
        .filter(F.col("tx_count") > more_than)
        .select(
            "user_id", F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"), "tx_count",
        )
    )
