"""The silver job: a stream of payloads into dimensions, facts, alerts and quarantine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from kwarta.config import DEFAULT_RULES, Lake, Rules
from kwarta.plans import load, silver
from kwarta.session import even_splits


def load_micro_batch(
    cleansed: DataFrame, load_id: str, lake: Lake, rules: Rules = DEFAULT_RULES, history: bool = False
) -> load.Counts:
    """Load one micro-batch of cleansed rows. Loading it again changes nothing.

    The batch feeds several outputs, so it is cached once, good rows without their payload. Its rows are counted by
    the writes that store them. Without ``history`` the rules look at single rows, and what they say is cached too.
    """
    spark = cleansed.sparkSession
    kept = silver.lean(cleansed)
    batch = (kept if history else silver.reasoned(kept, rules)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        again = load.begin(spark, lake, load_id)
        counts = load.load_rows(silver.valid(batch), lake, load_id, rules, history, again, reasoned=not history)
        rejected = load.load_quarantine(silver.quarantined(batch), lake, load_id, streamed=True, again=again)
        load.finish(spark, lake, load_id)
        return replace(counts, rejected=rejected)
    finally:
        batch.unpersist()


def start(
    raw: DataFrame,
    lake: Lake,
    checkpoint: str,
    rules: Rules = DEFAULT_RULES,
    history: bool = False,
    interval: str | None = "10 seconds",
    extra: tuple[str, ...] = (),
    on_batch: Callable[[str, load.Counts], None] | None = None,
) -> StreamingQuery:
    """Start the job on a streaming ``raw`` whose ``value`` holds payloads.

    ``interval`` None processes what there is, in rate-limited micro-batches, and stops. A micro-batch
    that is replayed after a crash finds its rows stored and adds none. Redelivered events are caught
    by their stored keys rather than by a watermark, which would also drop late ones.

    ``history`` adds the rules on a user's past, by the same operators as a batch load: each micro-batch is
    scored together with what earlier ones stored of its users. ``on_batch`` is told each micro-batch's counts.
    """
    cleansed = silver.cleanse(silver.parse(raw, extra))

    def handle(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load_id = f"{query}-{batch_id}"
        counts = load_micro_batch(batch, load_id, lake, rules, history)
        if on_batch is not None:
            on_batch(load_id, counts)

    writer = (
        cleansed.writeStream.foreachBatch(handle)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    even_splits(raw.sparkSession)
    return writer.trigger(**trigger).start()
