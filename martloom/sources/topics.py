"""Message topics. The connector jar must be on the class path; broker options come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TOPIC_FORMAT = "kafka"


def read_topic_stream(
    spark: SparkSession,
    options: dict[str, str],
    topic: str,
    *,
    max_per_trigger: int | None = None,
    source: str = TOPIC_FORMAT,
) -> DataFrame:
    """Stream of a topic from its earliest offset; later runs go on from the checkpoint."""
    reader = spark.readStream.format(source).options(**options)
    reader = reader.option("startingOffsets", "earliest").option("subscribe", topic)
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def read_topic(spark: SparkSession, options: dict[str, str], topic: str, source: str = TOPIC_FORMAT) -> DataFrame:
    """Everything in a topic as a batch frame."""
    reader = spark.read.format(source).options(**options).option("startingOffsets", "earliest")
    return reader.option("subscribe", topic).load()


def write_topic(messages: DataFrame, options: dict[str, str], topic: str, sink: str = TOPIC_FORMAT) -> None:
    """Send the JSON ``value`` column of a batch frame to a topic."""
    messages.select("value").write.format(sink).options(**options).option("topic", topic).save()
