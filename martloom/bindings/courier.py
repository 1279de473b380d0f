"""Orders as delivery documents, customers as couriers, events as documents that arrive twice."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.bindings.registry import Tables, money, plain, query
from martloom.operators.changes import capture_changes
from martloom.operators.loads import increment, next_cursor, next_mark, page_after, upsert
from martloom.plans import courier
from martloom.plans.courier import Tier

NOW = dt.datetime(2024, 2, 1)
BEFORE = dt.datetime(2024, 1, 1)
TIERS = [Tier("0", "0.05", "100"), Tier("2.8", "0.07", "150"), Tier("3.0", "0.08", "175"), Tier("3.2", "0.10", "200")]


def stg_couriers(t: Tables) -> DataFrame:
    """One document per customer."""
    doc = F.struct(F.concat(F.lit("c"), "c_custkey").alias("_id"), F.col("c_name").alias("name"))
    return t.customer.select(F.col("c_custkey").alias("id"), F.to_json(doc).alias("object_value"))


def stg_deliveries(t: Tables) -> DataFrame:
    """One document per order, with a fraction of a second in its time."""
    doc = F.struct(
        F.concat(F.lit("o"), "o_orderkey").alias("order_id"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 00:00:00.123000")).alias("order_ts"),
        F.concat(F.lit("d"), "o_orderkey").alias("delivery_id"),
        F.concat(F.lit("c"), "o_custkey").alias("courier_id"),
        F.concat(F.lit("street "), (F.col("o_custkey") % 100).cast("string")).alias("address"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("rate"),
        money("o_totalprice").alias("sum"),
        money(F.floor("o_totalprice") / 100).alias("tip_sum"),
    )
    return t.orders.select(F.col("o_orderkey").alias("id"), F.to_json(doc).alias("object_value"))


def couriers(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("c"), "c_custkey").alias("courier_id"),
        F.col("c_name").alias("courier_name"),
    )


def orders(t: Tables) -> DataFrame:
    """Orders known so far: those still in status P have not arrived."""
    known = t.orders.where("o_orderstatus <> 'P'")
    return known.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("o"), "o_orderkey").alias("order_key"),
        F.col("o_custkey").alias("courier_id"),
        F.col("o_orderdate").alias("order_ts"),
    )


def timestamps(t: Tables) -> DataFrame:
    days = t.orders.select(F.col("o_orderdate").alias("ts")).distinct()
    return days.select(F.date_format("ts", "yyyyMMdd").cast("long").alias("id"), "ts")


EVENT_DOC = """'{"object_id":"u' || cast(user_id as varchar) || '-' || event_type || '","event":'
               || cast(event_id as varchar) || '}'"""


@query(
    "land_documents",
    f"""with docs as (
      select 'u' || cast(user_id as varchar) || '-' || event_type as object_id, {EVENT_DOC} as object_value,
             event_id, ts < timestamp '2024-01-08' as early from events),
    newest as (
      select early, object_id, max_by(object_value, event_id) as object_value from docs group by early, object_id),
    first_load as (
      select row_number() over (order by object_id) as id, object_id, object_value from newest where early),
    second as (select object_id, object_value from newest where not early),
    added as (
      select (select max(id) from first_load) + row_number() over (order by object_id) as id, object_id, object_value
      from second where object_id not in (select object_id from first_load))
    select cast(id as bigint) as id, object_id, object_value, '2024-02-01 00:00:00.000000' as update_ts from added
    union all
    select cast(f.id as bigint), f.object_id, coalesce(s.object_value, f.object_value),
           case when s.object_id is null then '2024-01-01 00:00:00.000000' else '2024-02-01 00:00:00.000000' end
    from first_load f left join second s on f.object_id = s.object_id""",
)
def land(t: Tables) -> DataFrame:
    """Two pulls: the first week into an empty table, the rest over it."""
    doc = F.struct(F.concat(F.lit("u"), "user_id", F.lit("-"), "event_type").alias("object_id"), F.col("event_id").alias("event"))
    docs = t.events.select("ts", F.to_json(doc).alias("object_value"), F.col("event_id").alias("arrival"))
    empty = t.spark.createDataFrame([], "id long, object_id string, object_value string, update_ts timestamp")
    early = F.col("ts") < dt.datetime(2024, 1, 8)
    first = courier.land_documents(empty, docs.where(early), "object_id", BEFORE)
    return plain(courier.land_documents(first, docs.where(~early), "object_id", NOW))


@query("courier_dim", "select c_custkey as id, 'c' || cast(c_custkey as varchar) as courier_id, c_name as courier_name from customer")
def courier_dim(t: Tables) -> DataFrame:
    return plain(courier.courier_dim_increment(stg_couriers(t), -1))


@query(
    "courier_dim_page",
    """select c_custkey as id, 'c' || cast(c_custkey as varchar) as courier_id, c_name as courier_name
       from customer where c_custkey > 49 order by c_custkey limit 100""",
)
def courier_dim_page(t: Tables) -> DataFrame:
    return plain(courier.courier_dim_increment(stg_couriers(t), 49, limit=100))


@query("next_mark", "select max(o_orderkey) as mark from orders where o_orderkey > 99")
def mark(t: Tables) -> DataFrame:
    return plain(next_mark(increment(stg_deliveries(t), "id", 99), "id"))


@query(
    "delivery_dim",
    """select o_orderkey as id, o_orderkey as order_id, 'd' || cast(o_orderkey as varchar) as delivery_id,
              'street ' || cast(o_custkey % 100 as varchar) as address
       from orders where o_orderstatus <> 'P'""",
)
def delivery_dim(t: Tables) -> DataFrame:
    return plain(courier.delivery_dim_increment(stg_deliveries(t), orders(t), -1))


@query("deliveries_without_order", "select o_orderkey as id from orders where o_orderstatus = 'P'")
def without_order(t: Tables) -> DataFrame:
    return plain(courier.deliveries_without_order(stg_deliveries(t), orders(t), -1).select("id"))


@query(
    "rate_dim",
    """select o_orderkey as id, o_custkey as courier_id, cast(strftime(o_orderdate, '%Y%m%d') as bigint) as date_id,
              cast(substr(o_orderpriority, 1, 1) as bigint) as rate
       from orders join customer on o_custkey = c_custkey""",
)
def rate_dim(t: Tables) -> DataFrame:
    return plain(courier.rate_increment(stg_deliveries(t), couriers(t), timestamps(t), -1))


@query(
    "cursor_pages",
    """select (row_number() over (order by day, o_orderkey) - 1) // 400 + 1 as page, o_orderkey
       from (select o_orderkey, cast(o_orderdate as date) as day from orders)
       qualify row_number() over (order by day, o_orderkey) <= 1200""",
)
def cursor_pages(t: Tables) -> DataFrame:
    """Three pages of 400 orders by day; many orders share a day, so pages end between equal days."""
    cursor, after, pages = ("day", "o_orderkey"), None, []
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    for number in (1, 2, 3):
        page = page_after(rows, cursor, after, 400)
        pages.append(page.select(F.lit(number).alias("page"), "o_orderkey"))
        after = next_cursor(page, cursor).first()["cursor"]
    return plain(pages[0].unionByName(pages[1]).unionByName(pages[2]))


@query(
    "courier_changes",
    """with old as (select c_custkey as id, c_name as name from customer where c_custkey % 7 <> 0),
            fresh as (select c_custkey as id, case when c_custkey % 3 = 0 then c_name || ' jr' else c_name end as name
                      from customer where c_custkey % 5 <> 0)
       select coalesce(f.id, o.id) as id, coalesce(f.name, o.name) as name,
              case when o.id is null then 'insert' when f.id is null then 'delete' else 'update' end as change
       from old o full join fresh f on o.id = f.id where o.name is distinct from f.name""",
)
def courier_changes(t: Tables) -> DataFrame:
    """Couriers that came, went or were renamed between two snapshots."""
    key = F.col("c_custkey")
    old = t.customer.where(key % 7 != 0).select(key.alias("id"), F.col("c_name").alias("name"))
    name = F.when(key % 3 == 0, F.concat("c_name", F.lit(" jr"))).otherwise(F.col("c_name"))
    return plain(capture_changes(old, t.customer.where(key % 5 != 0).select(key.alias("id"), name.alias("name")), ["id"]))


@query(
    "courier_renamed",
    """select 'c' || cast(c_custkey as varchar) as courier_id,
              case when c_custkey % 3 = 0 then c_name || ' jr' else c_name end as courier_name from customer""",
)
def courier_renamed(t: Tables) -> DataFrame:
    """The dimension after a second pull in which every third courier has another name under its old row id."""
    renamed = F.when(F.col("c_custkey") % 3 == 0, F.concat("c_name", F.lit(" jr"))).otherwise(F.col("c_name"))
    empty = t.spark.createDataFrame([], "id long, object_id string, object_value string, update_ts timestamp")
    landed, dim, after = empty, None, None
    pulls = ((t.customer, BEFORE), (t.customer.where("c_custkey % 3 = 0").withColumn("c_name", renamed), NOW))
    for people, now in pulls:
        doc = F.to_json(F.struct(F.concat(F.lit("c"), "c_custkey").alias("_id"), F.col("c_name").alias("name")))
        pull = people.select(doc.alias("object_value"), F.col("c_custkey").alias("arrival"))
        landed = t.stored(courier.land_documents(landed, pull, "_id", now), "landed")
        fresh = courier.courier_versions(landed, after)
        after = next_cursor(fresh, courier.VERSION_CURSOR).first()["cursor"]
        dim = fresh if dim is None else upsert(dim, fresh, ["courier_id"], ["update_ts"])
    return plain(dim.select("courier_id", "courier_name"))


#: The first run loads a page of 300 documents and knows two couriers in three; the second knows all and goes on.
RATE_RUNS_SQL = """
with docs as (
  select o_orderkey as id, o_custkey as courier_id, cast(strftime(o_orderdate, '%Y%m%d') as bigint) as date_id,
         cast(substr(o_orderpriority, 1, 1) as bigint) as rate, row_number() over (order by o_orderkey) as place
  from orders join customer on o_custkey = c_custkey)
"""


def _rate_runs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows of two runs, and what waits after each."""
    stg, times, some = stg_deliveries(t), timestamps(t), couriers(t).where("id % 3 <> 0")
    first = courier.rate_increment(stg, some, times, -1, 300)
    waits = t.stored(courier.rates_waiting(stg, some, times, -1, BEFORE, 300), "waiting")
    mark = next_mark(courier.delivery_page(stg, -1, 300), "id").first()["mark"]
    second = courier.rate_increment(stg, couriers(t), times, mark, waiting=waits)
    return first, waits, second, courier.rates_waiting(stg, couriers(t), times, mark, NOW, waiting=waits)


@query(
    "rates_two_runs",
    RATE_RUNS_SQL + """select case when place <= 300 and courier_id % 3 <> 0 then 1 else 2 end as run, id, courier_id,
                              date_id, rate from docs""",
)
def rates_two_runs(t: Tables) -> DataFrame:
    first, _, second, _ = _rate_runs(t)
    return plain(first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2))))


@query(
    "rates_unmatched",
    RATE_RUNS_SQL + """select 1 as run, id, '2024-01-01 00:00:00.000000' as waiting_since from docs
                       where place <= 300 and courier_id % 3 = 0""",
)
def rates_unmatched(t: Tables) -> DataFrame:
    """Documents that wait after each of two runs; after the second none does, as every courier has arrived."""
    _, after_first, _, after_second = _rate_runs(t)
    both = after_first.withColumn("run", F.lit(1)).unionByName(after_second.withColumn("run", F.lit(2)))
    return plain(both.select("run", "id", "waiting_since"))


FACT_SQL = """
with fact as (
  select o_orderkey as id, o_custkey as courier_id, o_orderkey as order_id,
         cast(substr(o_orderpriority, 1, 1) as bigint) as rate, cast(o_totalprice as decimal(14,2)) as order_sum,
         cast(floor(o_totalprice) / 100 as decimal(14,2)) as tips_sum, o_orderdate
  from orders where o_orderstatus <> 'P')
"""


@query(
    "courier_fact",
    FACT_SQL
    + """select id, courier_id, order_id, rate, cast(order_sum as double) as order_sum,
                cast(tips_sum as double) as tips_sum from fact""",
)
def courier_fact(t: Tables) -> DataFrame:
    return plain(courier.courier_sales_fact(stg_deliveries(t), orders(t), -1))


def _fact_runs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows of two runs over pages of 300 orders and all others, and what waits after each.

    Documents of every fourth order come between the runs.
    """
    stg, known = stg_deliveries(t), orders(t)
    early = stg.where("id % 4 <> 0")
    first = courier.courier_sales_fact(early, known, -1, 300)
    waits = t.stored(courier.orders_waiting(early, known, -1, BEFORE, 300), "waiting")
    mark = next_mark(courier.order_page(known, -1, 300), "id").first()["mark"]
    second = courier.courier_sales_fact(stg, known, mark, waiting=waits)
    return first, waits, second, courier.orders_waiting(stg, known, mark, NOW, waiting=waits)


@query(
    "facts_two_runs",
    FACT_SQL
    + """, placed as (select *, row_number() over (order by id) as place from fact)
    select case when place <= 300 and id % 4 <> 0 then 1 else 2 end as run, id, courier_id, rate,
           cast(order_sum as double) as order_sum from placed""",
)
def facts_two_runs(t: Tables) -> DataFrame:
    first, _, second, _ = _fact_runs(t)
    both = first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))
    return plain(both.select("run", "id", "courier_id", "rate", "order_sum"))


@query(
    "facts_unmatched",
    FACT_SQL
    + """, placed as (select id, row_number() over (order by id) as place from fact)
    select 1 as run, id, '2024-01-01 00:00:00.000000' as waiting_since from placed where place <= 300 and id % 4 = 0""",
)
def facts_unmatched(t: Tables) -> DataFrame:
    """Orders that wait for their document after each of two runs; after the second none does."""
    _, after_first, _, after_second = _fact_runs(t)
    both = after_first.withColumn("run", F.lit(1)).unionByName(after_second.withColumn("run", F.lit(2)))
    return plain(both.select("run", "id", "waiting_since"))


@query(
    "assign_courier",
    """select o_orderkey as id, 'o' || cast(o_orderkey as varchar) as order_key, o_custkey as courier_id
       from orders where o_orderstatus <> 'P'""",
)
def assign(t: Tables) -> DataFrame:
    unassigned = orders(t).select("id", "order_key", F.lit(None).cast("long").alias("courier_id"))
    return plain(courier.assign_courier(unassigned, stg_deliveries(t), couriers(t)))


@query(
    "courier_ledger",
    FACT_SQL
    + """, months as (
      select courier_id, year(o_orderdate) as y, month(o_orderdate) as m, count(*) as orders_count,
             sum(order_sum) as total, sum(rate) as rates, sum(tips_sum) as tips,
             sum(greatest(cast(order_sum * cast(0.05 as decimal(4,3)) as decimal(14,2)), 100)) as pay0,
             sum(greatest(cast(order_sum * cast(0.07 as decimal(4,3)) as decimal(14,2)), 150)) as pay1,
             sum(greatest(cast(order_sum * cast(0.08 as decimal(4,3)) as decimal(14,2)), 175)) as pay2,
             sum(greatest(cast(order_sum * cast(0.10 as decimal(4,3)) as decimal(14,2)), 200)) as pay3
      from fact group by all),
    paid as (
      select *, cast(case when rates * 10 >= 32 * orders_count then pay3 when rates >= 3 * orders_count then pay2
             when rates * 10 >= 28 * orders_count then pay1 else pay0 end as decimal(14,2)) as pay from months)
    select 'c' || cast(courier_id as varchar) as courier_id, c_name as courier_name, y as settlement_year,
           m as settlement_month, orders_count, cast(total as double) as orders_total_sum,
           cast((rates * 200 + orders_count) // (2 * orders_count) as bigint) / 100.0 as rate_avg,
           cast(cast(cast(total as decimal(14,2)) * cast(0.25 as decimal(4,3)) as decimal(14,2)) as double)
             as order_processing_fee,
           cast(pay as double) as courier_order_sum, cast(tips as double) as courier_tips_sum,
           cast(cast(cast(pay + tips as decimal(14,2)) * cast(0.95 as decimal(4,3)) as decimal(14,2)) as double)
             as courier_reward_sum
    from paid join customer on courier_id = c_custkey""",
)
def ledger(t: Tables) -> DataFrame:
    fact = courier.courier_sales_fact(stg_deliveries(t), orders(t), -1)
    times = orders(t).select(F.col("id").alias("order_id"), "order_ts")
    return plain(courier.courier_ledger(fact, couriers(t), times, TIERS))
