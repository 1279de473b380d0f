"""Customers and their orders as users and orders; status F is closed."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.bindings.registry import Tables, money, plain, query
from martloom.plans import rfm

RULES = rfm.RfmRules(since_year=1998, closed="F", floor_date=dt.date(1997, 1, 1))

METRICS_SQL = """
with metrics as (
  select o_custkey as user_id,
         max(case when o_orderstatus = 'F' then cast(o_orderdate as date) else date '1997-01-01' end) as last_order,
         sum(case when o_orderstatus = 'F' then 1 else 0 end) as order_count,
         sum(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(14,2)) else 0 end) as order_sum
  from customer join orders on c_custkey = o_custkey
  where extract(year from o_orderdate) >= 1998
  group by o_custkey)
"""
RECENCY = "cast(ntile(5) over (order by last_order, user_id) as bigint) as recency"
FREQUENCY = "cast(ntile(5) over (order by order_count, user_id) as bigint) as frequency"
MONETARY = "cast(ntile(5) over (order by order_sum, user_id) as bigint) as monetary_value"


def users(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("id"))


def orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_ts"),
        F.col("o_orderstatus").alias("status"),
        money("o_totalprice").alias("payment"),
    )


@query("rfm_recency", f"{METRICS_SQL} select user_id, {RECENCY} from metrics")
def recency(t: Tables) -> DataFrame:
    return plain(rfm.rfm_recency(users(t), orders(t), RULES))


@query("rfm_frequency", f"{METRICS_SQL} select user_id, {FREQUENCY} from metrics")
def frequency(t: Tables) -> DataFrame:
    return plain(rfm.rfm_frequency(users(t), orders(t), RULES))


@query("rfm_monetary", f"{METRICS_SQL} select user_id, {MONETARY} from metrics")
def monetary(t: Tables) -> DataFrame:
    return plain(rfm.rfm_monetary(users(t), orders(t), RULES))


@query("rfm_segments", f"{METRICS_SQL} select user_id, {RECENCY}, {FREQUENCY}, {MONETARY} from metrics")
def segments(t: Tables) -> DataFrame:
    return plain(rfm.rfm_segments(users(t), orders(t), RULES))


@query(
    "rfm_include_inactive",
    f"""{METRICS_SQL}, everyone as (
      select c_custkey as user_id, coalesce(last_order, date '1997-01-01') as last_order,
             coalesce(order_count, 0) as order_count, coalesce(order_sum, 0) as order_sum
      from customer left join metrics on c_custkey = user_id)
    select user_id, {RECENCY}, {FREQUENCY}, {MONETARY} from everyone""",
)
def with_inactive(t: Tables) -> DataFrame:
    return plain(rfm.rfm_segments(users(t), orders(t), replace(RULES, include_inactive=True)))


@query(
    "rfm_metrics",
    f"""{METRICS_SQL} select user_id, cast(last_order as varchar) as last_order,
        cast(order_count as bigint) as order_count, cast(order_sum as double) as order_sum from metrics""",
)
def metrics(t: Tables) -> DataFrame:
    return plain(rfm.customer_metrics(users(t), orders(t), RULES))
