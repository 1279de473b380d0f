"""Line items as sales: the city is the customer's nation, return flag R is a refund."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.bindings.registry import Tables, money, plain, query
from martloom.plans import calendar as calendars
from martloom.plans import sales

STAGING_SQL = """
with staging as (
  select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as uniq_id, l_shipdate as date_time,
         c_nationkey as city_id, o_custkey as customer_id, c_name as first_name, c_mktsegment as last_name,
         l_partkey as item_id, p_name as item_name, cast(l_quantity as bigint) as quantity,
         cast(l_extendedprice as decimal(14,2)) as payment_amount,
         case when l_returnflag = 'R' then 'refunded' else 'shipped' end as status
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join part on l_partkey = p_partkey)
"""
FACT_SQL = """, sales as (
  select cast(strftime(date_time, '%Y%m%d') as bigint) as date_id, date_time, item_id, customer_id, city_id, quantity,
         case when status = 'shipped' then payment_amount else -payment_amount end as payment_amount, status
  from staging)
"""
NEW_SINCE = dt.datetime(1996, 1, 1)


def staging(t: Tables) -> DataFrame:
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("uniq_id"),
        F.col("l_shipdate").alias("date_time"),
        F.col("c_nationkey").alias("city_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.col("l_partkey").alias("item_id"),
        F.col("p_name").alias("item_name"),
        F.col("l_quantity").cast("long").alias("quantity"),
        money("l_extendedprice").alias("payment_amount"),
        F.when(F.col("l_returnflag") == "R", "refunded").otherwise("shipped").alias("status"),
    )


def calendar(t: Tables) -> DataFrame:
    return calendars.calendar_of(t.lineitem, "l_shipdate")


@query(
    "calendar",
    """select cast(strftime(d, '%Y%m%d') as bigint) as date_id, cast(cast(d as date) as varchar) as date_actual,
              cast(strftime(d, '%V') as bigint) as week_of_year, strftime(d, '%G-W%V') as week_of_year_iso
       from (select unnest(generate_series(min(l_shipdate), max(l_shipdate), interval 1 day)) as d from lineitem)""",
)
def calendar_query(t: Tables) -> DataFrame:
    return plain(calendar(t))


@query(
    "sales_ingest_dedupe",
    """select uniq_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') as l_shipdate, l_partkey, l_suppkey,
              l_quantity, l_extendedprice, 'shipped' as status
       from (select *, row_number() over (partition by uniq_id
                    order by l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) as n
             from (select *, cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as uniq_id
                   from lineitem))
       where n = 1""",
)
def ingest_dedupe(t: Tables) -> DataFrame:
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    raw = t.lineitem.select(
        F.col("l_linenumber").alias("id"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("uniq_id"), *order
    )
    return plain(sales.clean_increment(raw, [F.col(c).asc_nulls_last() for c in order]))


@query(
    "dim_city_new",
    """select distinct cast(c_nationkey as bigint) as city_id, n_name as city_name
       from customer join nation on c_nationkey = n_nationkey
       where c_nationkey not in (select n_nationkey from nation join region on n_regionkey = r_regionkey
                                 where r_name in ('AFRICA', 'AMERICA'))""",
)
def city_new(t: Tables) -> DataFrame:
    stg = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_nationkey").alias("city_id"), F.col("n_name").alias("city_name"), "c_custkey"
    )
    loaded = t.nation.join(t.region.where(F.col("r_name").isin("AFRICA", "AMERICA")), F.col("n_regionkey") == F.col("r_regionkey"))
    dim = loaded.select(F.col("n_nationkey").alias("city_id"))
    return plain(sales.new_dimension_rows(stg, dim, "city_id", ["city_name"], ["c_custkey"]))


@query(
    "dim_item_new",
    STAGING_SQL
    + """select item_id, item_name from (
           select item_id, item_name, row_number() over (partition by item_id
                  order by date_time desc, uniq_id desc, item_name desc) as n
           from staging
           where item_id not in (select item_id from staging where date_time < timestamp '1995-07-01'))
         where n = 1""",
)
def item_new(t: Tables) -> DataFrame:
    stg = staging(t)
    dim = t.lineitem.where(F.col("l_shipdate") < dt.datetime(1995, 7, 1)).select(F.col("l_partkey").alias("item_id"))
    return plain(sales.new_dimension_rows(stg, dim, "item_id", ["item_name"], ["date_time", "uniq_id"]))


@query(
    "dim_customer_new",
    STAGING_SQL
    + """select customer_id, min(first_name) as first_name, min(last_name) as last_name,
                cast(max(city_id) as bigint) as city_id
         from staging
         where customer_id not in (select o_custkey from orders where o_orderdate < timestamp '1996-01-01')
         group by customer_id""",
)
def customer_new(t: Tables) -> DataFrame:
    dim = t.orders.where(F.col("o_orderdate") < NEW_SINCE).select(F.col("o_custkey").alias("customer_id"))
    return plain(sales.new_customer_rows(staging(t), dim, ["date_time"]))


SALES_COLUMNS = """date_id, item_id, customer_id, cast(city_id as bigint) as city_id, quantity,
                   cast(payment_amount as double) as payment_amount, status"""


@query("sales_fact", STAGING_SQL + FACT_SQL + f"select {SALES_COLUMNS} from sales")
def fact(t: Tables) -> DataFrame:
    return plain(sales.sales_fact(staging(t), calendar(t)))


@query(
    "sales_fact_day",
    STAGING_SQL + FACT_SQL + f"select {SALES_COLUMNS} from sales where cast(date_time as date) = date '1998-03-10'",
)
def fact_day(t: Tables) -> DataFrame:
    return plain(sales.sales_fact(staging(t), calendar(t), "1998-03-10"))


RETENTION_SQL = """, weekly as (
  select strftime(date_time, '%G-W%V') as period_name, cast(strftime(date_time, '%V') as bigint) as period_id,
         customer_id, status, item_id % 5 as item_id, count(*) as orders, sum(payment_amount) as revenue
  from sales {where} group by all)
select period_name, period_id, item_id,
  cast(sum(case when orders = 1 and status <> 'refunded' then 1 else 0 end) as bigint) as new_customers_count,
  cast(sum(case when orders > 1 and status <> 'refunded' then 1 else 0 end) as bigint) as returning_customers_count,
  cast(sum(case when status = 'refunded' then 1 else 0 end) as bigint) as refunded_customer_count,
  cast(sum(case when orders = 1 and status <> 'refunded' then revenue else 0 end) as double) as new_customers_revenue,
  cast(sum(case when orders > 1 and status <> 'refunded' then revenue else 0 end) as double)
    as returning_customers_revenue,
  cast(sum(case when status = 'refunded' then revenue else 0 end) as double) as customers_refunded
from weekly group by period_name, period_id, item_id
"""


def retention_sales(t: Tables) -> DataFrame:
    """Single parts seldom sell twice a week, so five item groups stand for the items."""
    return sales.sales_fact(staging(t), calendar(t)).withColumn("item_id", F.col("item_id") % 5)


@query("customer_retention", STAGING_SQL + FACT_SQL + RETENTION_SQL.format(where=""))
def retention(t: Tables) -> DataFrame:
    return plain(sales.customer_retention(retention_sales(t), calendar(t)))


@query(
    "customer_retention_week",
    STAGING_SQL + FACT_SQL + RETENTION_SQL.format(where="where strftime(date_time, '%G-W%V') = '1998-W53'"),
)
def retention_week(t: Tables) -> DataFrame:
    return plain(sales.customer_retention(retention_sales(t), calendar(t), dt.date(1999, 1, 1)))
