"""Group membership vault and group conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.keys import md5_key
from martloom.operators.loads import with_literals
from martloom.operators.ranking import top_k
from martloom.operators.vault import KeyFunction, load_link

LINK_KEY = "hk_l_user_group_activity"
HUB_KEYS = ["hk_user_id", "hk_group_id"]

# Fixed value: event text of a user joining a group.
ADDED = "add"


def group_link(
    group_log: DataFrame,
    users: DataFrame,
    groups: DataFrame,
    load_dt: object,
    source: str,
    link: DataFrame | None = None,
    key: KeyFunction = md5_key,
) -> DataFrame:
    """Membership link: one row per user and group seen in the log.

    The log is reduced to its distinct pairs before the hub lookups. Pairs without a hub row
    have no key and are left out.
    """
    pairs = (
        group_log.select("user_id", "group_id")
        .distinct()
        .join(users.select("user_id", "hk_user_id"), "user_id", "left")
        .join(groups.select("group_id", "hk_group_id"), "group_id", "left")
    )
    return load_link(pairs, link, LINK_KEY, HUB_KEYS, load_dt, source, key=key)


def group_history(
    group_log: DataFrame, users: DataFrame, groups: DataFrame, link: DataFrame, load_dt: object, source: str
) -> DataFrame:
    """History satellite: every log row under its membership link; unknown members have no key."""
    rows = (
        group_log.join(groups.select("group_id", "hk_group_id"), "group_id", "left")
        .join(users.select("user_id", "hk_user_id"), "user_id", "left")
        .join(link.select(LINK_KEY, *HUB_KEYS), HUB_KEYS, "left")
        .select(LINK_KEY, "user_id_from", "event", F.col("datetime").alias("event_dt"))
    )
    return with_literals(rows, load_dt=load_dt, load_src=source)


def active_users(link: DataFrame, user_message: DataFrame, groups_dialogs: DataFrame) -> DataFrame:
    """Members with at least one message, counted per group."""
    wrote = user_message.join(groups_dialogs, "hk_message_id").select(*HUB_KEYS).distinct()
    return (
        link.select(*HUB_KEYS)
        .join(wrote, HUB_KEYS, "left_semi")
        .groupBy("hk_group_id")
        .agg(F.countDistinct("hk_user_id").alias("cnt_users_in_group_with_messages"))
    )


def users_with_messages(
    link: DataFrame, user_message: DataFrame, groups_dialogs: DataFrame, k: int = 10
) -> DataFrame:
    """The k groups with the fewest active users; ties by group key."""
    counts = active_users(link, user_message, groups_dialogs)
    return top_k(counts, k, [F.col("cnt_users_in_group_with_messages"), F.col("hk_group_id")])


def added_users(
    link: DataFrame, history: DataFrame, groups: DataFrame, early_groups: int = 10, event: str = ADDED
) -> DataFrame:
    """Users added, counted for the earliest registered groups; ties by group key."""
    early = top_k(groups, early_groups, [F.col("registration_dt"), F.col("hk_group_id")]).select("hk_group_id")
    added = history.where(F.col("event") == event).select(LINK_KEY)
    return (
        link.join(early, "hk_group_id", "left_semi")
        .join(added, LINK_KEY, "left_semi")
        .groupBy("hk_group_id")
        .agg(F.countDistinct("hk_user_id").alias("cnt_added_users"))
    )


def users_added_to_early_groups(
    link: DataFrame, history: DataFrame, groups: DataFrame, k: int = 10, event: str = ADDED
) -> DataFrame:
    """The k earliest groups by users added, fewest first."""
    counts = added_users(link, history, groups, k, event)
    return top_k(counts, k, [F.col("cnt_added_users"), F.col("hk_group_id")])


def group_conversion(
    link: DataFrame,
    history: DataFrame,
    groups: DataFrame,
    user_message: DataFrame,
    groups_dialogs: DataFrame,
    k: int = 10,
    event: str = ADDED,
) -> DataFrame:
    """Share of added users that write messages, for the k earliest groups, best first."""
    added = added_users(link, history, groups, k, event)
    chosen = link.join(added.select("hk_group_id"), "hk_group_id", "left_semi")
    active = active_users(chosen, user_message, groups_dialogs)
    ratio = F.col("cnt_users_in_group_with_messages") / F.col("cnt_added_users")
    return (
        added.join(active, "hk_group_id", "left")
        .withColumn("group_conversion", ratio)
        .orderBy(F.col("group_conversion").desc_nulls_last(), F.col("hk_group_id"))
    )
