"""Raw courier documents to dimensions, fact and monthly settlement ledger."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.text import json_field, json_fields
from martloom.operators.changes import still_waiting, with_waiting
from martloom.operators.loads import increment, page_after, surrogate_id, update_from, upsert
from martloom.operators.ranking import latest_per_key

COURIER_FIELDS = "_id string, name string"
DELIVERY_FIELDS = (
    "order_id string, order_ts string, delivery_id string, courier_id string, address string, "
    "rate int, sum decimal(14,2), tip_sum decimal(14,2)"
)

# Order of document versions: the time of the last change, then the row id, which is unique.
VERSION_CURSOR = ("update_ts", "id")

# Fixed values of the ledger: processing fee and share of pay and tips that is paid out.
PROCESSING_FEE = "0.25"
PAYOUT_SHARE = "0.95"
MONEY = "decimal(14,2)"


class Tier(NamedTuple):
    """Pay for an average rating of at least ``rate_from``: a share of each order, at least ``min_pay``."""

    rate_from: str
    share: str
    min_pay: str


def land_documents(existing: DataFrame, incoming: DataFrame, key_field: str, now: object) -> DataFrame:
    """Landing table after upserting JSON documents by key.

    ``incoming`` has ``object_value`` (and ``arrival``, the order within the pull). A document
    that comes again keeps its row id; new documents get the next serial ids.
    """
    docs = incoming.select(json_field("object_value", key_field).alias("object_id"), "object_value", "arrival")
    docs = latest_per_key(docs.where("object_id is not null"), ["object_id"], ["arrival", "object_value"])
    docs = docs.select("object_id", "object_value", F.lit(now).alias("update_ts"))
    known = existing.select("object_id", "id")
    changed = docs.join(known, "object_id")
    last_id = existing.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last_id"))
    added = surrogate_id(docs.join(known, "object_id", "left_anti"), ["object_id"]).withColumn(
        "id", F.col("id") + last_id.scalar()
    )
    return upsert(existing, changed.unionByName(added), ["object_id"], ["update_ts"])


def courier_dim_increment(stg: DataFrame, after_id: int, limit: int | None = None) -> DataFrame:
    """Couriers past the id mark, in id order when a page size is given."""
    page = increment(stg.select("id", "object_value"), "id", after_id, limit)
    docs = page.select("id", F.inline(F.array(json_fields("object_value", COURIER_FIELDS))))
    return docs.select("id", F.col("_id").alias("courier_id"), F.col("name").alias("courier_name"))


def _deliveries(stg: DataFrame) -> DataFrame:
    """Typed documents. ``inline`` keeps join and filter conditions from parsing a text again."""
    return stg.select("id", F.inline(F.array(json_fields("object_value", DELIVERY_FIELDS))))


def courier_versions(stg: DataFrame, after: Sequence[object] | None, limit: int | None = None) -> DataFrame:
    """Couriers whose document came or changed past the cursor (update_ts, id): a renamed one comes again.

    ``upsert`` them into the dimension by ``courier_id`` in ``update_ts`` order.
    """
    page = page_after(stg.select("id", "object_value", "update_ts"), VERSION_CURSOR, after, limit)
    docs = page.select("id", "update_ts", F.inline(F.array(json_fields("object_value", COURIER_FIELDS))))
    return docs.select("id", "update_ts", F.col("_id").alias("courier_id"), F.col("name").alias("courier_name"))


def delivery_dim_increment(
    stg: DataFrame, orders: DataFrame, after_id: int, limit: int | None = None, waiting: DataFrame | None = None
) -> DataFrame:
    """Deliveries past the id mark whose order is known.

    A page is ``limit`` documents, whatever they match, so the next mark is that of ``delivery_page``. ``waiting`` are
    documents that ``deliveries_waiting`` gave earlier.
    """
    docs = _deliveries(delivery_page(stg, after_id, limit, waiting))
    keys = orders.select(F.col("id").alias("_order_id"), "order_key")
    return docs.join(keys, docs["order_id"] == keys["order_key"]).select(
        docs["id"], F.col("_order_id").alias("order_id"), "delivery_id", "address"
    )


def delivery_page(stg: DataFrame, after_id: int, limit: int | None = None, waiting: DataFrame | None = None) -> DataFrame:
    """Documents (id, object_value, waiting_since) of one run: a page past the mark, and those still waiting."""
    page = increment(stg.select("id", "object_value"), "id", after_id, limit)
    return with_waiting(page, waiting, ["id"])


def deliveries_waiting(
    stg: DataFrame, orders: DataFrame, after_id: int, now: object, limit: int | None = None, waiting: DataFrame | None = None
) -> DataFrame:
    """Documents of the run whose order has not arrived, to hand to the next run."""
    loaded = delivery_dim_increment(stg, orders, after_id, limit, waiting)
    return still_waiting(delivery_page(stg, after_id, limit, waiting), loaded, ["id"], now)


def deliveries_without_order(stg: DataFrame, orders: DataFrame, after_id: int) -> DataFrame:
    """Documents past the mark whose order has not arrived; feed them to the next run."""
    docs = increment(stg, "id", after_id)
    keys = orders.select(F.col("order_key").alias("_key"))
    return docs.join(keys, json_field("object_value", "order_id") == F.col("_key"), "left_anti")


def rate_increment(
    stg: DataFrame,
    couriers: DataFrame,
    timestamps: DataFrame,
    after_id: int,
    limit: int | None = None,
    waiting: DataFrame | None = None,
) -> DataFrame:
    """Ratings past the id mark with the ids of their courier and second-precision timestamp.

    Pages and ``waiting`` are those of ``delivery_dim_increment``.
    """
    docs = _deliveries(delivery_page(stg, after_id, limit, waiting)).select(
        "id", F.col("courier_id").alias("_courier"), "rate", to_second("order_ts").alias("_ts")
    )
    people = couriers.select(F.col("id").alias("courier_id"), F.col("courier_id").alias("_courier"))
    times = timestamps.select(F.col("id").alias("date_id"), F.col("ts").alias("_ts"))
    return docs.join(people, "_courier").join(times, "_ts").select("id", "courier_id", "date_id", "rate")


def rates_waiting(
    stg: DataFrame,
    couriers: DataFrame,
    timestamps: DataFrame,
    after_id: int,
    now: object,
    limit: int | None = None,
    waiting: DataFrame | None = None,
) -> DataFrame:
    """Documents of the run whose courier or timestamp has not arrived, to hand to the next run."""
    loaded = rate_increment(stg, couriers, timestamps, after_id, limit, waiting)
    return still_waiting(delivery_page(stg, after_id, limit, waiting), loaded, ["id"], now)


def to_second(text: str | Column) -> Column:
    """Timestamp without zone, rounded to the second as a cast to precision 0 does."""
    ts = F.try_to_timestamp(F.col(text) if isinstance(text, str) else text).cast("timestamp_ntz")
    return F.date_trunc("second", ts + F.expr("interval '0.5' second")).cast("timestamp_ntz")


def courier_sales_fact(
    stg: DataFrame, orders: DataFrame, after_id: int, limit: int | None = None, waiting: DataFrame | None = None
) -> DataFrame:
    """Rate, order sum and tips of delivered orders past the order id mark.

    A page is ``limit`` orders with all their documents; the next mark is that of ``order_page``. ``waiting`` are orders
    that ``orders_waiting`` gave earlier.
    """
    docs = _deliveries(stg).select(
        F.col("order_id").alias("order_key"), "rate", F.col("sum").alias("order_sum"), F.col("tip_sum").alias("tips_sum")
    )
    known = order_page(orders, after_id, limit, waiting).select("id", "order_key", "courier_id")
    return known.join(docs, "order_key").select(
        "id", "courier_id", F.col("id").alias("order_id"), "rate", "order_sum", "tips_sum"
    )


def order_page(orders: DataFrame, after_id: int, limit: int | None = None, waiting: DataFrame | None = None) -> DataFrame:
    """Orders (id, order_key, courier_id, waiting_since) of one run: a page past the mark, and those still waiting."""
    page = increment(orders.select("id", "order_key", "courier_id"), "id", after_id, limit)
    return with_waiting(page, waiting, ["id"])


def orders_waiting(
    stg: DataFrame, orders: DataFrame, after_id: int, now: object, limit: int | None = None, waiting: DataFrame | None = None
) -> DataFrame:
    """Orders of the run without a delivery document, to hand to the next run."""
    loaded = courier_sales_fact(stg, orders, after_id, limit, waiting)
    return still_waiting(order_page(orders, after_id, limit, waiting), loaded, ["id"], now)


def assign_courier(orders: DataFrame, deliveries: DataFrame, couriers: DataFrame) -> DataFrame:
    """Orders with the courier of their latest delivery document; others keep what they have."""
    docs = _deliveries(deliveries).select("id", F.col("order_id").alias("order_key"), F.col("courier_id").alias("_courier"))
    people = couriers.select(F.col("id").alias("courier_id"), F.col("courier_id").alias("_courier"))
    found = docs.join(people, "_courier").groupBy("order_key").agg(F.max_by("courier_id", "id").alias("courier_id"))
    return update_from(orders, found, ["order_key"], ["courier_id"])


def courier_ledger(
    fact: DataFrame, couriers: DataFrame, order_times: DataFrame, tiers: Sequence[Tier]
) -> DataFrame:
    """Settlement per courier and month.

    ``order_times`` gives ``order_id`` and ``order_ts``. The pay of every tier is summed in the
    one aggregation and the tier of the average rating is picked afterwards, so the fact is not
    joined with its own averages. Reward is (pay + tips) times the paid-out share.
    """
    ordered = sorted(tiers, key=lambda t: float(t.rate_from))

    def pay(tier: Tier) -> Column:
        share = (F.col("order_sum") * F.lit(tier.share).cast("decimal(5,4)")).cast(MONEY)
        return F.sum(F.greatest(share, F.lit(tier.min_pay).cast(MONEY)))

    months = (
        fact.join(order_times.select("order_id", "order_ts"), "order_id")
        .withColumn("settlement_year", F.year("order_ts"))
        .withColumn("settlement_month", F.month("order_ts"))
        .groupBy("courier_id", "settlement_year", "settlement_month")
        .agg(
            F.count(F.lit(1)).alias("orders_count"),
            F.sum("order_sum").cast(MONEY).alias("orders_total_sum"),
            (F.sum("rate").cast("decimal(18,0)") / F.count("rate").cast("decimal(18,0)")).alias("_rate"),
            F.sum("tips_sum").cast(MONEY).alias("courier_tips_sum"),
            *[pay(t).cast(MONEY).alias(f"_pay{i}") for i, t in enumerate(ordered)],
        )
    )
    chosen: Column = F.lit(None).cast(MONEY)
    for i, tier in enumerate(ordered):
        chosen = F.when(F.col("_rate") >= F.lit(tier.rate_from).cast("decimal(5,2)"), F.col(f"_pay{i}")).otherwise(chosen)
    fee = F.col("orders_total_sum") * F.lit(PROCESSING_FEE).cast("decimal(5,4)")
    reward = (F.col("courier_order_sum") + F.col("courier_tips_sum")) * F.lit(PAYOUT_SHARE).cast("decimal(5,4)")
    names = couriers.select(F.col("id").alias("_courier"), "courier_id", "courier_name")
    return (
        months.withColumnRenamed("courier_id", "_courier")
        .join(names, "_courier")
        .withColumn("courier_order_sum", chosen)
        .select(
            "courier_id",
            "courier_name",
            "settlement_year",
            "settlement_month",
            "orders_count",
            "orders_total_sum",
            F.col("_rate").cast("decimal(3,2)").alias("rate_avg"),
            fee.cast(MONEY).alias("order_processing_fee"),
            "courier_order_sum",
            "courier_tips_sum",
            reward.cast(MONEY).alias("courier_reward_sum"),
        )
    )
