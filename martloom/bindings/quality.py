"""Checks over the line items, orders and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.bindings.registry import Tables, plain, query
from martloom.operators import quality

LINE_KEY = ["l_orderkey", "l_linenumber"]


@query(
    "dq_duplicates",
    """select cast(count(*) as bigint) as total,
              count(distinct cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar)) as uniq
       from lineitem""",
)
def duplicates(t: Tables) -> DataFrame:
    return plain(quality.duplicate_report(t.lineitem, LINE_KEY))


@query(
    "dq_nulls",
    """with shown as (select case when o_orderstatus <> 'P' then o_orderdate end as order_ts, o_custkey, o_totalprice
                      from orders)
       select 'order_ts' as column_name, count(*) - count(order_ts) as missing from shown
       union all select 'o_custkey', count(*) - count(o_custkey) from shown
       union all select 'o_totalprice', count(*) - count(o_totalprice) from shown""",
)
def nulls(t: Tables) -> DataFrame:
    shown = t.orders.withColumn("order_ts", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    return plain(quality.null_report(shown, ["order_ts", "o_custkey", "o_totalprice"]))


@query(
    "dq_not_null",
    "select event_id, user_id from events where event_type = 'error'",
)
def not_null(t: Tables) -> DataFrame:
    shown = t.events.withColumn("kind", F.when(F.col("event_type") != "error", F.col("event_type")))
    return plain(quality.check_not_null(shown, ["event_id", "kind"]).select("event_id", "user_id"))


@query(
    "dq_unique",
    """select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, count(*) as occurrences
       from lineitem group by l_orderkey, l_linenumber having count(*) > 1""",
)
def unique(t: Tables) -> DataFrame:
    return plain(quality.check_unique(t.lineitem, LINE_KEY))


@query(
    "dq_range",
    """select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_quantity from lineitem
       where l_quantity < 5 or l_quantity > 45""",
)
def value_range(t: Tables) -> DataFrame:
    return plain(quality.check_range(t.lineitem, "l_quantity", 5, 45).select(*LINE_KEY, "l_partkey", "l_quantity"))


@query(
    "dq_expr",
    """select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, 'tax above discount' as rule
       from lineitem where not (l_tax <= l_discount)""",
)
def row_rule(t: Tables) -> DataFrame:
    broken = quality.check_expr(t.lineitem, "tax above discount", "l_tax <= l_discount")
    return plain(broken.select(*LINE_KEY, "l_partkey", "rule"))


@query(
    "dq_fk",
    """select l_orderkey, count(*) as orphans from lineitem
       where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P') group by l_orderkey""",
)
def foreign_key(t: Tables) -> DataFrame:
    return plain(quality.check_fk(t.lineitem, t.orders.where("o_orderstatus <> 'P'"), {"l_orderkey": "o_orderkey"}))
