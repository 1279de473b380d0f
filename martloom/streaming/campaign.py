"""Campaign matching stream: one source, one lookup, two sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from martloom.plans.campaign import campaign_match, campaign_messages, feedback_rows
from martloom.streaming.sinks import BatchSink


def campaign_stream(
    source: DataFrame,
    subscribers: DataFrame,
    to_table: BatchSink,
    to_topic: BatchSink,
    checkpoint: str,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Match campaigns as they arrive and hand every micro-batch to both sinks.

    "Now" is taken once per micro-batch. The batch is computed once and kept while both sinks
    write it. A failing sink fails the batch, which is then repeated with the same id.
    """
    matched = campaign_match(source, subscribers)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            to_table(feedback_rows(kept), batch_id)
            to_topic(campaign_messages(kept), batch_id)
        finally:
            kept.unpersist()

    writer = matched.writeStream.option("checkpointLocation", checkpoint).foreachBatch(deliver)
    return writer.trigger(**(trigger or {"processingTime": "25 seconds"})).start()
