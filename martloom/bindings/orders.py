"""Line items as order messages: one message per line, its supplier as restaurant; status F is closed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.bindings.registry import Tables, plain, query
from martloom.functions.keys import uuid3_key
from martloom.plans import orders

LOAD_DT = dt.datetime(2024, 2, 1)


def uuid_sql(text: str) -> str:
    """The name-based UUID of a text expression in SQL."""
    digest = f"md5(unhex('6ba7b8149dad11d180b400c04fd430c8') || encode({text}))"
    return f"""(select substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-3' || substr(h, 14, 3) || '-'
        || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-'
        || substr(h, 21, 12) from (select {digest} as h))"""


LINES_SQL = """
with lines as (
  select cast(o_orderkey as varchar) as order_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as order_dt,
         cast(o_totalprice as varchar) as cost, cast(cast(floor(o_totalprice) as bigint) as varchar) as payment,
         case when o_orderstatus = 'F' then 'CLOSED' else o_orderstatus end as status,
         cast(o_custkey as varchar) as user_id, c_name as username,
         case when o_custkey % 2 = 0 then lower(c_name) else c_name end as userlogin,
         cast(s_suppkey as varchar) as restaurant_id, s_name as restaurant_name,
         cast(p_partkey as varchar) as product_id, p_name as product_name, p_type as category_name,
         l_returnflag
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey
  where l_returnflag <> 'N')
"""
STAMP = "'2024-02-01 00:00:00.000000' as load_dt, 'orders_kafka' as load_src"


def message_columns(t: Tables) -> DataFrame:
    """The joined columns that messages are made of."""
    heads = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    items = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        t.part, F.col("l_partkey") == F.col("p_partkey")
    )
    return items.join(heads.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))


def message_text() -> Column:
    """The JSON message of a row; lines with return flag N are of another type, which the vault skips."""
    user = F.struct(
        F.col("o_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.when(F.col("o_custkey") % 2 == 0, F.lower("c_name")).alias("login"),
    )
    restaurant = F.struct(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"))
    product = F.struct(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("category")
    )
    payload = F.struct(
        F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date"),
        F.col("o_totalprice").alias("cost"),
        F.floor("o_totalprice").alias("payment"),
        F.when(F.col("o_orderstatus") == "F", "CLOSED").otherwise(F.col("o_orderstatus")).alias("status"),
        user.alias("user"),
        restaurant.alias("restaurant"),
        F.array(product).alias("products"),
    )
    body = F.struct(
        F.col("o_orderkey").cast("string").alias("object_id"),
        F.when(F.col("l_returnflag") == "N", "user").otherwise("order").alias("object_type"),
        payload.alias("payload"),
    )
    return F.to_json(body).alias("value")


def raw_messages(t: Tables) -> DataFrame:
    """All JSON messages."""
    return message_columns(t).select(message_text())


def messages(t: Tables) -> DataFrame:
    return orders.parse_messages(raw_messages(t))


@query(
    "order_messages",
    LINES_SQL + "select order_id as object_id, user_id, product_id, cost, status, userlogin from lines",
)
def order_messages(t: Tables) -> DataFrame:
    flat = orders.product_rows(orders.order_rows(messages(t)))
    return flat.select(F.col("order_id").cast("string").alias("object_id"), "user_id", "product_id", "cost", "status", "userlogin")


USER, PRODUCT, CATEGORY = uuid_sql("user_id"), uuid_sql("product_id"), uuid_sql("category_name")
RESTAURANT, ORDER = uuid_sql("restaurant_id"), uuid_sql("order_id")
TABLE_SQL = {
    "h_user": ["user_id", f"{USER} as h_user_pk"],
    "h_product": ["product_id", f"{PRODUCT} as h_product_pk"],
    "h_category": ["category_name", f"{CATEGORY} as h_category_pk"],
    "h_restaurant": ["restaurant_id", f"{RESTAURANT} as h_restaurant_pk"],
    "h_order": ["cast(order_id as bigint) as order_id", "order_dt", f"{ORDER} as h_order_pk"],
    "l_order_product": ["order_id, product_id", f"{ORDER} as h_order_pk", f"{PRODUCT} as h_product_pk"],
    "l_product_restaurant": ["product_id, restaurant_id", f"{PRODUCT} as h_product_pk", f"{RESTAURANT} as h_restaurant_pk"],
    "l_product_category": ["product_id, category_name", f"{PRODUCT} as h_product_pk", f"{CATEGORY} as h_category_pk"],
    "l_order_user": ["order_id, user_id", f"{ORDER} as h_order_pk", f"{USER} as h_user_pk"],
    "s_user_names": ["username", "userlogin", f"{USER} as h_user_pk", f"{uuid_sql('user_id || username || userlogin')} as hk_user_names_hashdiff"],
    "s_product_names": ["product_name", f"{PRODUCT} as h_product_pk", f"{uuid_sql('product_id || product_name')} as hk_product_names_hashdiff"],
    "s_restaurant_names": ["restaurant_name", f"{RESTAURANT} as h_restaurant_pk", f"{uuid_sql('restaurant_id || restaurant_name')} as hk_restaurant_names_hashdiff"],
    "s_order_cost": ["cost", "payment", f"{ORDER} as h_order_pk", f"{uuid_sql('order_id || cost || payment')} as hk_order_cost_hashdiff"],
    "s_order_status": ["status", f"{ORDER} as h_order_pk", f"{uuid_sql('order_id || status')} as hk_order_status_hashdiff"],
}
LINKS = {
    "l_order_product": ("hk_order_product_pk", "h_order_pk", "h_product_pk"),
    "l_product_restaurant": ("hk_product_restaurant_pk", "h_product_pk", "h_restaurant_pk"),
    "l_product_category": ("hk_product_category_pk", "h_product_pk", "h_category_pk"),
    "l_order_user": ("hk_order_user_pk", "h_order_pk", "h_user_pk"),
}


def table_sql(table: str) -> str:
    if table not in LINKS:
        return f"{LINES_SQL} select distinct {', '.join(TABLE_SQL[table])}, {STAMP} from lines"
    pk, first, second = LINKS[table]
    inner = f"select distinct {', '.join(TABLE_SQL[table][1:])} from (select distinct {TABLE_SQL[table][0]} from lines)"
    return f"{LINES_SQL} select {first}, {second}, {uuid_sql(f'{first} || {second}')} as {pk}, {STAMP} from ({inner})"


def register(table: str) -> None:
    @query(f"vault_{table}", table_sql(table))
    def build(t: Tables) -> DataFrame:
        return plain(orders.vault_table(messages(t), table, LOAD_DT))


for name in orders.VAULT_TABLES:
    register(name)


ITEMS_SQL = (
    LINES_SQL
    + f""", items as (
  select {ORDER} as order_id, {USER} as user_id, {PRODUCT} as product_id, product_name, {CATEGORY} as category_id,
         category_name from lines where status = 'CLOSED')
"""
)


@query("closed_order_items", ITEMS_SQL + "select * from items")
def closed_items(t: Tables) -> DataFrame:
    return orders.closed_order_items(messages(t)).drop("line")


@query("downstream_messages")
def downstream(t: Tables) -> DataFrame:
    """Carries random ids, so only its rows can be counted."""
    return orders.downstream_messages(orders.closed_order_items(messages(t)))


@query(
    "downstream_round_trip",
    LINES_SQL
    + f"""select {uuid_sql("order_id || '/0'")} as object_id, {USER} as user_id, {PRODUCT} as product_id,
          product_name, category_name from lines where status = 'CLOSED'""",
)
def downstream_round_trip(t: Tables) -> DataFrame:
    """Sent with ids made from the order and line, and read back by the counter stage."""
    items = orders.closed_order_items(messages(t).withColumn("source_id", F.col("object_id")), "source_id")
    sent = orders.downstream_messages(items, uuid3_key("source_id", "line", sep="/"))
    read = orders.parse_downstream(sent)
    return read.select("object_id", "user_id", "product_id", "product_name", "category_name")


@query(
    "user_product_counters",
    ITEMS_SQL + "select user_id, product_id, max(product_name) as product_name, count(*) as order_cnt from items group by user_id, product_id",
)
def product_counters(t: Tables) -> DataFrame:
    return plain(orders.user_product_counters(orders.closed_order_items(messages(t))))


@query(
    "user_category_counters",
    ITEMS_SQL + "select user_id, category_id, max(category_name) as category_name, count(*) as order_cnt from items group by user_id, category_id",
)
def category_counters(t: Tables) -> DataFrame:
    return plain(orders.user_category_counters(orders.closed_order_items(messages(t))))


#: Whole orders: every line is a product, and the supplier of the first line is the restaurant.
WHOLE_SQL = LINES_SQL.replace("where l_returnflag <> 'N'", "").replace("l_returnflag\n", "l_linenumber\n")


def whole_orders(t: Tables) -> DataFrame:
    """One message per order with all its lines as products."""
    product = F.struct(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("category")
    )
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(
        t.supplier, F.col("l_suppkey") == F.col("s_suppkey")
    )
    line = F.struct("l_linenumber", product.alias("product"), "s_suppkey", "s_name")
    packed = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    first = F.col("lines")[0]
    payload = F.struct(
        F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date"),
        F.col("o_totalprice").alias("cost"),
        F.floor("o_totalprice").alias("payment"),
        F.when(F.col("o_orderstatus") == "F", "CLOSED").otherwise(F.col("o_orderstatus")).alias("status"),
        F.struct(F.col("o_custkey").cast("string").alias("id"), F.col("c_name").alias("name")).alias("user"),
        F.struct(first["s_suppkey"].cast("string").alias("id"), first["s_name"].alias("name")).alias("restaurant"),
        F.col("lines.product").alias("products"),
    )
    heads = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    body = F.struct(F.col("o_orderkey").cast("string").alias("object_id"), F.lit("order").alias("object_type"), payload.alias("payload"))
    return heads.join(packed, F.col("l_orderkey") == F.col("o_orderkey")).select(F.to_json(body).alias("value"))


@query(
    "vault_whole_orders",
    WHOLE_SQL
    + f"""select h_order_pk, h_product_pk, {uuid_sql("h_order_pk || h_product_pk")} as hk_order_product_pk, {STAMP}
          from (select distinct {ORDER} as h_order_pk, {PRODUCT} as h_product_pk from lines)""",
)
def vault_whole_orders(t: Tables) -> DataFrame:
    return plain(orders.vault_table(orders.parse_messages(whole_orders(t)), "l_order_product", LOAD_DT))


@query(
    "downstream_whole_orders",
    WHOLE_SQL
    + f"""select {uuid_sql("order_id || '/' || cast(line as varchar)")} as object_id, {USER} as user_id,
                 {PRODUCT} as product_id, product_name
          from (select *, row_number() over (partition by order_id order by l_linenumber, product_id) - 1 as line from lines)
          where status = 'CLOSED'""",
)
def downstream_whole_orders(t: Tables) -> DataFrame:
    """Lines of closed orders of several products; their place in the message is part of the id."""
    parsed = orders.parse_messages(whole_orders(t)).withColumn("source_id", F.col("object_id"))
    sent = orders.downstream_messages(orders.closed_order_items(parsed, "source_id"), uuid3_key("source_id", "line", sep="/"))
    return orders.parse_downstream(sent).select("object_id", "user_id", "product_id", "product_name")


@query(
    "counters_whole_orders",
    WHOLE_SQL
    + f"""select {USER} as user_id, {CATEGORY} as category_id, max(category_name) as category_name, count(*) as order_cnt
          from lines where status = 'CLOSED' group by 1, 2""",
)
def counters_whole_orders(t: Tables) -> DataFrame:
    return plain(orders.user_category_counters(orders.closed_order_items(orders.parse_messages(whole_orders(t)))))
