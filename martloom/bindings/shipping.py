"""Line items as state rows of a shipment (the order); descriptions are packed from order columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.bindings.registry import Tables, money, plain, query
from martloom.plans import shipping

AS_OF = dt.datetime(2002, 1, 1, 12, 0, 0)

LOG_SQL = """
with log as (
  select l_partkey * 8 + l_linenumber as id, l_orderkey as shipping_id,
         cast(o_totalprice as decimal(14,2)) as payment_amount, l_shipdate as state_datetime,
         c_nationkey as vendor_id, n_name as shipping_country,
         cast('0.' || lpad(cast(n_nationkey + 1 as varchar), 3, '0') as decimal(14,3)) as shipping_country_base_rate,
         case when l_linestatus = 'F' then 'finished' else 'in_progress' end as status,
         case l_returnflag when 'R' then 'returned' when 'A' then 'recieved' else 'booked' end as state,
         o_orderdate + interval 60 day + interval 5 hour as shipping_plan_datetime,
         o_custkey % 50 as agreement_id,
         'agr-' || cast(o_custkey % 50 as varchar) as agreement_number,
         cast('0.' || lpad(cast(o_custkey % 50 as varchar), 2, '0') as decimal(14,3)) as agreement_rate,
         cast('0.' || lpad(cast(o_custkey % 7 as varchar), 3, '0') as decimal(14,3)) as agreement_commission,
         substr(o_orderpriority, 1, 1) || 'p' as transfer_type,
         case o_orderstatus when 'F' then 'train' when 'O' then 'ship' else 'airplane' end as transfer_model,
         cast('0.0' || substr(o_orderpriority, 1, 1) || '5' as decimal(14,3)) as shipping_transfer_rate
  from lineitem join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey),
rates as (
  select cast(row_number() over (order by shipping_country, shipping_country_base_rate) as bigint) as id, *
  from (select distinct shipping_country, shipping_country_base_rate from log)),
agreements as (
  select distinct agreement_id, agreement_number, agreement_rate, agreement_commission from log),
transfers as (
  select cast(row_number() over (order by transfer_type, transfer_model, shipping_transfer_rate) as bigint) as id, *
  from (select distinct transfer_type, transfer_model, shipping_transfer_rate from log)),
info as (
  select distinct l.shipping_id, l.payment_amount, l.vendor_id, l.shipping_plan_datetime,
         r.id as shipping_country_rate_id, a.agreement_id as shipping_agreement_id, t.id as shipping_transfer_id
  from log l left join rates r using (shipping_country) join agreements a using (agreement_id)
  join transfers t on l.transfer_type = t.transfer_type and l.transfer_model = t.transfer_model
    and l.shipping_transfer_rate = t.shipping_transfer_rate),
latest as (
  select * from (select shipping_id, status, state,
                        row_number() over (partition by shipping_id order by state_datetime desc, id desc) as n
                 from log) where n = 1),
spans as (
  select shipping_id, min(state_datetime) as first_dt, max(state_datetime) as last_dt
  from log where state <> 'returned' group by shipping_id),
statuses as (
  select s.shipping_id, l.status, l.state, s.first_dt as shipping_start_fact_datetime,
         case when l.state in ('recieved', 'returned') then s.last_dt end as shipping_end_fact_datetime
  from spans s join latest l on s.shipping_id = l.shipping_id)
"""


def log(t: Tables) -> DataFrame:
    """Shipping log with the packed texts, some with a doubled separator."""
    number = F.col("o_custkey") % 50
    digit = F.substring("o_orderpriority", 1, 1)
    model = (
        F.when(F.col("o_orderstatus") == "F", "train").when(F.col("o_orderstatus") == "O", "ship").otherwise("airplane")
    )
    agreement = F.concat(
        number.cast("string"),
        F.when(number % 2 == 0, "::").otherwise(":"),
        F.lit("agr-"),
        number.cast("string"),
        F.lit(":0."),
        F.lpad(number.cast("string"), 2, "0"),
        F.lit(":0."),
        F.lpad((F.col("o_custkey") % 7).cast("string"), 3, "0"),
    )
    orders = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey",
            money("o_totalprice").alias("payment_amount"),
            F.col("c_nationkey").alias("vendor_id"),
            F.expr("o_orderdate + interval '60 5' day to hour").alias("shipping_plan_datetime"),
            F.col("n_name").alias("shipping_country"),
            F.concat(F.lit("0."), F.lpad((F.col("n_nationkey") + 1).cast("string"), 3, "0"))
            .cast("decimal(14,3)")
            .alias("shipping_country_base_rate"),
            agreement.alias("vendor_agreement_description"),
            F.concat(digit, F.lit("p:"), model).alias("shipping_transfer_description"),
            F.concat(F.lit("0.0"), digit, F.lit("5")).cast("decimal(14,3)").alias("shipping_transfer_rate"),
        )
    )
    states = t.lineitem.select(
        (F.col("l_partkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("shipping_id"),
        F.col("l_shipdate").alias("state_datetime"),
        F.when(F.col("l_linestatus") == "F", "finished").otherwise("in_progress").alias("status"),
        F.when(F.col("l_returnflag") == "R", "returned")
        .when(F.col("l_returnflag") == "A", "recieved")
        .otherwise("booked")
        .alias("state"),
    )
    # Merged on the shipment, which is also what the marts group by.
    return states.join(orders.hint("merge"), F.col("shipping_id") == F.col("o_orderkey")).drop("o_orderkey")


@query(
    "shipping_country_rates",
    LOG_SQL
    + """select id, shipping_country, cast(shipping_country_base_rate as double) as shipping_country_base_rate
         from rates""",
)
def country_rates(t: Tables) -> DataFrame:
    return plain(shipping.shipping_country_rates(log(t)))


@query(
    "shipping_agreement",
    LOG_SQL
    + """select agreement_id, agreement_number, cast(agreement_rate as double) as agreement_rate,
         cast(agreement_commission as double) as agreement_commission from agreements""",
)
def agreement(t: Tables) -> DataFrame:
    return plain(shipping.shipping_agreement(log(t)))


@query(
    "shipping_transfer",
    LOG_SQL
    + """select id, transfer_type, transfer_model, cast(shipping_transfer_rate as double) as shipping_transfer_rate
         from transfers""",
)
def transfer(t: Tables) -> DataFrame:
    return plain(shipping.shipping_transfer(log(t)))


@query(
    "shipping_info",
    LOG_SQL
    + """select shipping_id, cast(payment_amount as double) as payment_amount, cast(vendor_id as bigint) as vendor_id,
         strftime(shipping_plan_datetime, '%Y-%m-%d %H:%M:%S.%f') as shipping_plan_datetime,
         shipping_country_rate_id, shipping_agreement_id, shipping_transfer_id from info""",
)
def info(t: Tables) -> DataFrame:
    rows = log(t)
    return plain(shipping.shipping_info(rows, *shipping.shipping_references(rows)))


@query(
    "shipping_status",
    LOG_SQL
    + """select shipping_id, status, state,
         strftime(shipping_start_fact_datetime, '%Y-%m-%d %H:%M:%S.%f') as shipping_start_fact_datetime,
         strftime(shipping_end_fact_datetime, '%Y-%m-%d %H:%M:%S.%f') as shipping_end_fact_datetime from statuses""",
)
def status(t: Tables) -> DataFrame:
    return plain(shipping.shipping_status(log(t)))


@query(
    "shipping_datamart",
    LOG_SQL
    + """, ended as (
      select *, coalesce(shipping_end_fact_datetime, timestamp '2002-01-01 12:00:00') as end_dt from statuses)
    select distinct i.shipping_id, cast(i.vendor_id as bigint) as vendor_id, t.transfer_type,
      cast(date_part('day', e.end_dt - e.shipping_start_fact_datetime) as bigint) as full_day_at_shipping,
      e.end_dt > i.shipping_plan_datetime as is_delay,
      e.status = 'finished' as is_shipping_finish,
      cast(case when e.end_dt > i.shipping_plan_datetime
           then date_part('day', e.end_dt - i.shipping_plan_datetime) else 0 end as bigint) as delay_day_at_shipping,
      cast(i.payment_amount as double) as payment_amount,
      cast(cast(i.payment_amount * cast(r.shipping_country_base_rate + a.agreement_rate + t.shipping_transfer_rate
           as decimal(6,3)) as decimal(14,3)) as double) as vat,
      cast(cast(i.payment_amount * cast(a.agreement_commission as decimal(6,3)) as decimal(14,3)) as double) as profit
    from info i join transfers t on i.shipping_transfer_id = t.id join ended e on i.shipping_id = e.shipping_id
    join agreements a on i.shipping_agreement_id = a.agreement_id join rates r on i.shipping_country_rate_id = r.id""",
)
def datamart(t: Tables) -> DataFrame:
    rows = log(t)
    rates, agreements, transfers = shipping.shipping_references(rows)
    shipments = shipping.shipping_info(rows, rates, agreements, transfers)
    return plain(
        shipping.shipping_datamart(shipments, transfers, shipping.shipping_status(rows), agreements, rates, AS_OF)
    )
