"""Events as a group log: ``props.k`` is the group, a signup adds a user, a view is a message."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.bindings.registry import Tables, plain, query
from martloom.functions.keys import hash_key, md5_key
from martloom.functions.text import json_field
from martloom.operators.lineage import cut_lineage
from martloom.plans import groups

LOAD_DT = dt.datetime(2024, 2, 1)
SOURCE = "s3"

VAULT_SQL = """
with events_k as (
  select event_id, ts, user_id, event_type, cast(props ->> '$.k' as bigint) as group_id from events),
log as (
  select group_id, user_id, case when event_type = 'click' then user_id + 1 end as user_id_from,
         case event_type when 'signup' then 'add' when 'view' then 'message' else event_type end as event, ts
  from events_k),
link as (
  select distinct md5(concat_ws(chr(31), md5(cast(user_id as varchar)), md5(cast(group_id as varchar)))) as hk_link,
         md5(cast(user_id as varchar)) as hk_user_id, md5(cast(group_id as varchar)) as hk_group_id
  from log),
h_groups as (
  select md5(cast(group_id as varchar)) as hk_group_id, min(ts) as registration_dt from events_k group by group_id),
active as (
  select hk_group_id, count(distinct hk_user_id) as cnt_users_in_group_with_messages
  from (select md5(cast(user_id as varchar)) as hk_user_id, md5(cast(group_id as varchar)) as hk_group_id
        from events_k where event_type = 'view')
  group by hk_group_id),
early as (select hk_group_id from h_groups order by registration_dt, hk_group_id limit 10),
added as (
  select md5(cast(group_id as varchar)) as hk_group_id, count(distinct user_id) as cnt_added_users
  from log where event = 'add' and md5(cast(group_id as varchar)) in (select hk_group_id from early)
  group by 1)
"""


def events_k(t: Tables) -> DataFrame:
    return t.events.withColumn("group_id", json_field("props", "k").cast("long"))


def group_log(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return events_k(t).select(
        "group_id",
        "user_id",
        F.when(kind == "click", F.col("user_id") + 1).alias("user_id_from"),
        F.when(kind == "signup", "add").when(kind == "view", "message").otherwise(kind).alias("event"),
        F.col("ts").alias("datetime"),
    )


def h_users(t: Tables) -> DataFrame:
    return t.events.select("user_id").distinct().withColumn("hk_user_id", md5_key("user_id"))


def h_groups(t: Tables) -> DataFrame:
    first = events_k(t).groupBy("group_id").agg(F.min("ts").alias("registration_dt"))
    return first.withColumn("hk_group_id", md5_key("group_id"))


def link(t: Tables, known: DataFrame) -> DataFrame:
    return groups.group_link(group_log(t), h_users(t), known, LOAD_DT, SOURCE)


def history(t: Tables, known: DataFrame, held: DataFrame) -> DataFrame:
    return groups.group_history(group_log(t), h_users(t), known, held, LOAD_DT, SOURCE)


def messages(t: Tables, key: str | Column, name: str) -> DataFrame:
    return events_k(t).where("event_type = 'view'").select(
        md5_key(key).alias(name), md5_key("event_id").alias("hk_message_id")
    )


@query(
    "group_link",
    VAULT_SQL
    + """select hk_link as hk_l_user_group_activity, hk_user_id, hk_group_id,
         '2024-02-01 00:00:00.000000' as load_dt, 's3' as load_src from link""",
)
def group_link(t: Tables) -> DataFrame:
    return plain(link(t, h_groups(t)))


@query("group_link_hash64")
def group_link_hash64(t: Tables) -> DataFrame:
    """The same link under 64-bit keys, which SQL has no equal for."""
    users = h_users(t).withColumn("hk_user_id", hash_key("user_id"))
    known = h_groups(t).withColumn("hk_group_id", hash_key("group_id"))
    return plain(groups.group_link(group_log(t), users, known, LOAD_DT, SOURCE, key=hash_key))


@query(
    "group_link_partial",
    VAULT_SQL
    + """select distinct hk_link as hk_l_user_group_activity, hk_user_id, hk_group_id from link
         where hk_user_id in (select md5(cast(user_id as varchar)) from events where user_id % 7 <> 0)
           and hk_group_id in (select md5(cast(group_id as varchar)) from events_k where group_id % 5 <> 0)""",
)
def group_link_partial(t: Tables) -> DataFrame:
    """Some users and groups of the log are not in their hubs yet: no link points to nothing."""
    users, known = h_users(t).where("user_id % 7 <> 0"), h_groups(t).where("group_id % 5 <> 0")
    return plain(groups.group_link(group_log(t), users, known, LOAD_DT, SOURCE).drop("load_dt", "load_src"))


@query(
    "group_history_partial",
    VAULT_SQL
    + """select case when user_id % 7 <> 0 and group_id % 5 <> 0
                     then md5(concat_ws(chr(31), md5(cast(user_id as varchar)), md5(cast(group_id as varchar)))) end
           as hk_l_user_group_activity, user_id_from, event, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as event_dt
         from log""",
)
def group_history_partial(t: Tables) -> DataFrame:
    """An event without its user or group in the hubs stays, under no link."""
    users, known = h_users(t).where("user_id % 7 <> 0"), h_groups(t).where("group_id % 5 <> 0")
    held = groups.group_link(group_log(t), users, known, LOAD_DT, SOURCE)
    return plain(groups.group_history(group_log(t), users, known, held, LOAD_DT, SOURCE).drop("load_dt", "load_src"))


@query(
    "group_history",
    VAULT_SQL
    + """select md5(concat_ws(chr(31), md5(cast(user_id as varchar)), md5(cast(group_id as varchar))))
           as hk_l_user_group_activity, user_id_from, event, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as event_dt,
         '2024-02-01 00:00:00.000000' as load_dt, 's3' as load_src from log""",
)
def group_history(t: Tables) -> DataFrame:
    known = h_groups(t)
    return plain(history(t, known, link(t, known)))


@query(
    "group_messages_bottom10",
    VAULT_SQL + "select * from active order by cnt_users_in_group_with_messages, hk_group_id limit 10",
)
def messages_bottom10(t: Tables) -> DataFrame:
    wrote, held = messages(t, "user_id", "hk_user_id"), messages(t, "group_id", "hk_group_id")
    return plain(groups.users_with_messages(link(t, h_groups(t)), wrote, held))


@query("group_added_early10", VAULT_SQL + "select * from added order by cnt_added_users, hk_group_id limit 10")
def added_early10(t: Tables) -> DataFrame:
    known = h_groups(t)
    held = link(t, known)
    return plain(groups.users_added_to_early_groups(held, history(t, known, held), known))


@query(
    "group_conversion",
    VAULT_SQL
    + """select hk_group_id, cnt_added_users, cnt_users_in_group_with_messages,
         cnt_users_in_group_with_messages / cnt_added_users as group_conversion
         from added left join active using (hk_group_id)""",
)
def group_conversion(t: Tables) -> DataFrame:
    wrote, held = messages(t, "user_id", "hk_user_id"), messages(t, "group_id", "hk_group_id")
    known = cut_lineage(h_groups(t))
    members = cut_lineage(link(t, known))
    return plain(groups.group_conversion(members, history(t, known, members), known, wrote, held))
