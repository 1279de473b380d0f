"""Campaign matching; the same functions serve batch frames and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Fields of an incoming campaign message, in message order.
CAMPAIGN_SCHEMA = StructType(
    [
        StructField("restaurant_id", StringType()),
        StructField("adv_campaign_id", StringType()),
        StructField("adv_campaign_content", StringType()),
        StructField("adv_campaign_owner", StringType()),
        StructField("adv_campaign_owner_contact", StringType()),
        StructField("adv_campaign_datetime_start", LongType()),
        StructField("adv_campaign_datetime_end", LongType()),
        StructField("datetime_created", LongType()),
    ]
)


def now_seconds() -> Column:
    """Epoch seconds; a stream evaluates it once per micro-batch."""
    return F.unix_timestamp(F.current_timestamp())


def parse_campaigns(raw: DataFrame) -> DataFrame:
    """Typed rows from the JSON in ``value``; a broken message gives NULLs, which no filter passes."""
    return raw.select(F.from_json(F.col("value").cast("string"), CAMPAIGN_SCHEMA).alias("message")).select("message.*")


def active_campaigns(campaigns: DataFrame, now: Column | None = None) -> DataFrame:
    """Campaigns that have started and not ended: both bounds are open."""
    moment = now_seconds() if now is None else now
    return campaigns.where(
        (F.col("adv_campaign_datetime_start") < moment) & (F.col("adv_campaign_datetime_end") > moment)
    )


def match_subscribers(campaigns: DataFrame, subscribers: DataFrame, now: Column | None = None) -> DataFrame:
    """Campaign and subscriber per restaurant, stamped with the moment of the match."""
    moment = now_seconds() if now is None else now
    matched = campaigns.join(subscribers.drop("id"), "restaurant_id")
    return matched.select(
        *[f.name for f in CAMPAIGN_SCHEMA],
        "client_id",
        moment.cast("int").alias("trigger_datetime_created"),
    )


def campaign_match(raw: DataFrame, subscribers: DataFrame, now: Column | None = None) -> DataFrame:
    """Parse, keep what is active and match, in one plan."""
    return match_subscribers(active_campaigns(parse_campaigns(raw), now), subscribers, now)


def feedback_rows(matched: DataFrame) -> DataFrame:
    """Rows for the table sink, with an empty ``feedback``."""
    return matched.withColumn("feedback", F.lit(None).cast("string"))


def campaign_messages(matched: DataFrame) -> DataFrame:
    """JSON ``value`` for the topic sink."""
    return matched.select(F.to_json(F.struct(*matched.columns)).alias("value"))
