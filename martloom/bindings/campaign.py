"""Orders as campaign messages of a restaurant (the customer), running 90 days from the order date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.bindings.registry import Tables, plain, query
from martloom.plans import campaign

# Some order dates start exactly at this moment and are not active yet.
NOW = 896659200  # 1998-06-01 00:00:00 UTC

MATCH_SQL = """
with campaigns as (
  select cast(o_custkey as varchar) as restaurant_id, cast(o_orderkey as varchar) as adv_campaign_id,
         o_orderpriority as adv_campaign_content, 'owner' || cast(o_custkey as varchar) as adv_campaign_owner,
         o_orderstatus as adv_campaign_owner_contact,
         cast(epoch(o_orderdate) as bigint) as adv_campaign_datetime_start,
         cast(epoch(o_orderdate) as bigint) + 90 * 86400 as adv_campaign_datetime_end,
         cast(epoch(o_orderdate) as bigint) - 100 as datetime_created
  from orders),
matched as (
  select c.*, c_name as client_id, 896659200 as trigger_datetime_created
  from campaigns c join customer on restaurant_id = cast(c_custkey as varchar)
  where adv_campaign_datetime_start < 896659200 and adv_campaign_datetime_end > 896659200)
"""


def messages(t: Tables, end: Column | None = None) -> DataFrame:
    """Campaign JSON; ``end`` overrides the end where it is not NULL."""
    start = F.unix_timestamp("o_orderdate")
    usual = start + 90 * 86400
    body = F.to_json(
        F.struct(
            F.col("o_custkey").cast("string").alias("restaurant_id"),
            F.col("o_orderkey").cast("string").alias("adv_campaign_id"),
            F.col("o_orderpriority").alias("adv_campaign_content"),
            F.concat(F.lit("owner"), "o_custkey").alias("adv_campaign_owner"),
            F.col("o_orderstatus").alias("adv_campaign_owner_contact"),
            start.alias("adv_campaign_datetime_start"),
            (usual if end is None else F.coalesce(end, usual)).alias("adv_campaign_datetime_end"),
            (start - 100).alias("datetime_created"),
        )
    )
    return t.orders.select(body.alias("value"))


def subscribers(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("client_id"),
        F.col("c_custkey").cast("string").alias("restaurant_id"),
    )


@query(
    "campaign_match_batch",
    MATCH_SQL + "select * replace (cast(trigger_datetime_created as bigint) as trigger_datetime_created) from matched",
)
def match_batch(t: Tables) -> DataFrame:
    return plain(campaign.campaign_match(messages(t), subscribers(t), F.lit(NOW)))


@query(
    "campaign_messages",
    MATCH_SQL
    + """select '{"restaurant_id":"' || restaurant_id || '","adv_campaign_id":"' || adv_campaign_id
         || '","adv_campaign_content":"' || adv_campaign_content || '","adv_campaign_owner":"' || adv_campaign_owner
         || '","adv_campaign_owner_contact":"' || adv_campaign_owner_contact || '","adv_campaign_datetime_start":'
         || adv_campaign_datetime_start || ',"adv_campaign_datetime_end":' || adv_campaign_datetime_end
         || ',"datetime_created":' || datetime_created || ',"client_id":"' || client_id
         || '","trigger_datetime_created":' || trigger_datetime_created || '}' as value from matched""",
)
def match_messages(t: Tables) -> DataFrame:
    return campaign.campaign_messages(campaign.campaign_match(messages(t), subscribers(t), F.lit(NOW)))
