"""Customer segmentation by recency, frequency and monetary value, each scored 1 to 5."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import since_year
from martloom.operators.ranking import global_ntile


@dataclass(frozen=True)
class RfmRules:
    """Fixed values of the mart: first year, status code of a closed order, floor date, score count."""

    since_year: int = 2022
    closed: object = 4
    floor_date: dt.date = dt.date(2021, 1, 1)
    buckets: int = 5
    include_inactive: bool = False


SCORES = {"recency": "last_order", "frequency": "order_count", "monetary_value": "order_sum"}


def customer_metrics(users: DataFrame, orders: DataFrame, rules: RfmRules = RfmRules()) -> DataFrame:
    """Per user: latest closed order date, number of closed orders and their payments.

    ``users`` has ``id``; ``orders`` has ``user_id``, ``order_ts``, ``status`` and ``payment``.
    Orders are aggregated first and then matched with the users on the same key, which needs no
    second shuffle of the orders. A user without an order since the first year is left out
    unless ``include_inactive`` is set; then the user counts as floor date, 0 orders and 0 paid.
    """
    closed = F.col("status") == F.lit(rules.closed)
    floor = F.lit(rules.floor_date)
    per_user = (
        orders.where(since_year("order_ts", rules.since_year))
        .groupBy("user_id")
        .agg(
            F.max(F.when(closed, F.to_date("order_ts")).otherwise(floor)).alias("last_order"),
            F.count_if(closed).alias("order_count"),
            F.sum(F.when(closed, F.col("payment")).otherwise(F.lit(0))).alias("order_sum"),
        )
    )
    known = users.select(F.col("id").alias("user_id"))
    if not rules.include_inactive:
        return per_user.join(known, "user_id", "left_semi")
    return (
        known.join(per_user, "user_id", "left")
        .withColumn("last_order", F.coalesce("last_order", floor))
        .withColumn("order_count", F.coalesce("order_count", F.lit(0)))
        .withColumn("order_sum", F.coalesce("order_sum", F.lit(0)))
    )


def _scored(users: DataFrame, orders: DataFrame, rules: RfmRules, names: list[str]) -> DataFrame:
    metrics = customer_metrics(users, orders, rules)
    scores = {name: SCORES[name] for name in names}
    return global_ntile(metrics, scores, "user_id", rules.buckets).select("user_id", *names)


def rfm_recency(users: DataFrame, orders: DataFrame, rules: RfmRules = RfmRules()) -> DataFrame:
    return _scored(users, orders, rules, ["recency"])


def rfm_frequency(users: DataFrame, orders: DataFrame, rules: RfmRules = RfmRules()) -> DataFrame:
    return _scored(users, orders, rules, ["frequency"])


def rfm_monetary(users: DataFrame, orders: DataFrame, rules: RfmRules = RfmRules()) -> DataFrame:
    return _scored(users, orders, rules, ["monetary_value"])


def rfm_segments(users: DataFrame, orders: DataFrame, rules: RfmRules = RfmRules()) -> DataFrame:
    """All three scores from one aggregation."""
    return _scored(users, orders, rules, list(SCORES))
