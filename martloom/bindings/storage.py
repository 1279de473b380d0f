"""Loads that write tables and read them back, and file formats."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from martloom.bindings.registry import Tables, money, plain, query, scratch_folder
from martloom.operators import loads
from martloom.operators.asof import asof_lookup
from martloom.sources import files
from martloom.sources.jdbc import day_rows

ORDER_FIELDS = StructType(
    [
        StructField("o_orderkey", LongType()),
        StructField("o_custkey", LongType()),
        StructField("o_orderstatus", StringType()),
        StructField("o_totalprice", DoubleType()),
        StructField("order_day", DateType()),
    ]
)
ORDERS_SQL = """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(cast(o_orderdate as date) as varchar)
                as order_day from orders"""


def order_fields(t: Tables) -> DataFrame:
    return t.orders.select(*[f.name for f in ORDER_FIELDS][:-1], F.to_date("o_orderdate").alias("order_day"))


@query(
    "replace_period",
    """select year(o_orderdate) as year, o_orderkey, case when year(o_orderdate) = 1998 then 'second' else 'first' end
       as run from orders""",
)
def replace_period(t: Tables) -> DataFrame:
    """All years written once, 1998 again twice: one copy of each year is left."""
    path = scratch_folder(t.spark, "replace")
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"))
    loads.replace_period(rows.withColumn("run", F.lit("first")), path, ["year"])
    again = rows.where("year = 1998").withColumn("run", F.lit("second"))
    loads.replace_period(again, path, ["year"])
    loads.replace_period(again, path, ["year"])
    return plain(t.spark.read.parquet(path))


NEWEST_SQL = """
select user_id, event_type, event_id, value from (
  select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as n from events)
where n = 1
"""


@query("upsert_last_write", NEWEST_SQL)
def upsert(t: Tables) -> DataFrame:
    """Events of the later half laid over those of the earlier half."""
    rows = t.events.select("user_id", "event_type", "event_id", "value", "ts")
    late = F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")
    merged = loads.upsert(rows.where(~late), rows.where(late), ["user_id", "event_type"], ["ts", "event_id"])
    return plain(merged.drop("ts"))


@query("upsert_table", NEWEST_SQL)
def upsert_table(t: Tables) -> DataFrame:
    """The same upsert into a bucketed table, the second half loaded twice."""
    path = scratch_folder(t.spark, "upsert")
    rows = t.events.select("user_id", "event_type", "event_id", "value", "ts")
    late = F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")
    for half in (rows.where(~late), rows.where(late), rows.where(late)):
        loads.upsert_table(t.spark, path, half, ["user_id", "event_type"], ["ts", "event_id"], buckets=4)
    return plain(loads.read_upserted(t.spark, path).drop("ts"))


@query("add_counts", "select user_id, max(event_type) as event_type, count(*) as n from events group by user_id")
def add_counts(t: Tables) -> DataFrame:
    """Counters of the first half plus those of the second; the name is the larger event type."""
    late = F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("event_type").alias("event_type"))

    names = t.events.groupBy("user_id").agg(F.max("event_type").alias("event_type"))
    fresh = counted(t.events.where(late)).drop("event_type").join(names, "user_id")
    return plain(loads.add_counts(counted(t.events.where(~late)), fresh, ["user_id"], "n", ["event_type"]))


@query(
    "update_from",
    """select p_partkey, coalesce(max_price, p_retailprice) as p_retailprice from part left join (
         select l_partkey, max(l_extendedprice) as max_price from lineitem where l_returnflag = 'R' group by l_partkey)
       on p_partkey = l_partkey""",
)
def update_from(t: Tables) -> DataFrame:
    sold = t.lineitem.where("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("p_partkey"))
    prices = sold.agg(F.max("l_extendedprice").alias("p_retailprice"))
    return plain(loads.update_from(t.part.select("p_partkey", "p_retailprice"), prices, ["p_partkey"], ["p_retailprice"]))


@query(
    "surrogate_id",
    """select row_number() over (order by o_orderdate, o_custkey, o_orderkey) + 1000 as id, o_orderkey from orders""",
)
def surrogate_id(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderdate", "o_custkey", "o_orderkey")
    order = ["o_orderdate", "o_custkey", "o_orderkey"]
    return plain(loads.surrogate_id(rows, order, start_after=1000).select("id", "o_orderkey"))


@query("extract_day", "select o_orderkey, o_custkey from orders where cast(o_orderdate as date) = date '1998-03-10'")
def extract_day(t: Tables) -> DataFrame:
    return plain(day_rows(t.orders, "o_orderdate", "1998-03-10").select("o_orderkey", "o_custkey"))


@query("csv_round_trip", ORDERS_SQL)
def csv_round_trip(t: Tables) -> DataFrame:
    """Headerless dated extract, read back with a declared schema."""
    target = files.write_csv_extract(order_fields(t), scratch_folder(t.spark, "csv"), "orders", "1998-03-10")
    return plain(files.read_csv(t.spark, target, ORDER_FIELDS, sep=";", header=False))


def _lines(t: Tables) -> str:
    """Order lines as text; status P gets a field too many, low priority a bad number."""
    path = scratch_folder(t.spark, "rejects")
    good = F.concat_ws(";", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate"))
    line = (
        F.when(F.col("o_orderstatus") == "P", F.concat(good, F.lit(";extra")))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("x"), good))
        .otherwise(good)
    )
    t.orders.select(line.alias("value")).write.text(path)
    return path


@query("load_with_rejects", ORDERS_SQL + " where o_orderstatus <> 'P' and o_orderpriority <> '5-LOW'")
def load_with_rejects(t: Tables) -> DataFrame:
    return plain(files.load_with_rejects(t.spark, _lines(t), ORDER_FIELDS)[0])


@query(
    "rejected_lines",
    """select case when o_orderstatus = 'P' then line || ';extra' else 'x' || line end as line from (
         select *, o_orderkey || ';' || o_custkey || ';' || o_orderstatus || ';' || cast(o_totalprice as varchar) || ';'
                || cast(cast(o_orderdate as date) as varchar) as line
         from orders where o_orderstatus = 'P' or o_orderpriority = '5-LOW')""",
)
def rejected_lines(t: Tables) -> DataFrame:
    return files.load_with_rejects(t.spark, _lines(t), ORDER_FIELDS)[1]


@query("dated_parquet", "select o_orderkey, '1998-03-10' as date from orders")
def dated_parquet(t: Tables) -> DataFrame:
    """Written twice for the same day."""
    path = scratch_folder(t.spark, "dated")
    for _ in range(2):
        files.write_dated(t.orders.select("o_orderkey"), path, "1998-03-10")
    return plain(files.read_parquet(t.spark, path))


@query("ingest_csv", """select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as uniq_id,
                               max(l_partkey) as item_id, 'shipped' as status from lineitem group by 1""")
def ingest_csv(t: Tables) -> DataFrame:
    """A day's file with a header and no status, written from the line items and ingested."""
    path = scratch_folder(t.spark, "increment")
    rows = t.lineitem.select(
        F.col("l_linenumber").alias("id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("uniq_id"),
        F.date_format(F.date_sub(F.lit("2030-01-01"), F.col("l_partkey").cast("int")), "yyyy-MM-dd HH:mm:ss").alias("date_time"),
        F.col("l_partkey").alias("item_id"),
        money("l_extendedprice").alias("payment_amount"),
    )
    rows.write.option("header", True).csv(f"{path}/1998-03-10")
    return plain(files.ingest_increment(t.spark, path + "/{ds}", "1998-03-10").select("uniq_id", "item_id", "status"))


@query(
    "document_pages",
    """select '{"id":' || cast(event_id as varchar) || ',"kind":"' || event_type || '"}' as object_value from events""",
)
def document_pages(t: Tables) -> DataFrame:
    """Pages of fifty documents, landed as one JSON array per line and read back."""
    path = scratch_folder(t.spark, "pages")
    doc = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))
    pages = t.events.groupBy(F.floor(F.col("event_id") / 50)).agg(F.to_json(F.collect_list(doc)).alias("value"))
    pages.select("value").write.text(path)
    return files.read_document_pages(t.spark, path).select("object_value")


@query(
    "nullable_csv",
    """select o_orderkey, case when o_custkey % 3 = 0 then null else o_custkey end as o_custkey, o_orderstatus,
              o_totalprice, cast(cast(o_orderdate as date) as varchar) as order_day from orders""",
)
def nullable_csv(t: Tables) -> DataFrame:
    """Integers that are empty in the file, read under a declared schema and with a header."""
    path = scratch_folder(t.spark, "nullable")
    rows = order_fields(t).withColumn("o_custkey", F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")))
    rows.write.option("header", True).csv(path)
    return plain(files.read_csv(t.spark, path, ORDER_FIELDS))


@query("landed_files", ORDERS_SQL + " where o_orderstatus <> 'P' union all " + ORDERS_SQL + " where o_orderstatus = 'P'")
def landed_files(t: Tables) -> DataFrame:
    """Objects under several prefixes, as a download leaves them, read as one table."""
    path = scratch_folder(t.spark, "landed")
    for name, part in (("a", F.col("o_orderstatus") != "P"), ("b", F.col("o_orderstatus") == "P")):
        order_fields(t).where(part).write.option("header", True).option("sep", ";").csv(f"{path}/{name}")
    return plain(files.read_csv(t.spark, [f"{path}/a", f"{path}/b"], ORDER_FIELDS, sep=";"))


@query("appended", "select o_orderkey, o_orderstatus from orders union all select o_orderkey, o_orderstatus from orders where o_orderstatus = 'F'")
def appended(t: Tables) -> DataFrame:
    """A staging table by status that got one part twice: appends never replace."""
    path = scratch_folder(t.spark, "staging")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    loads.append(rows, path, ["o_orderstatus"])
    files.append_staging(rows.where("o_orderstatus = 'F'"), path, ["o_orderstatus"])
    return plain(t.spark.read.parquet(path).select("o_orderkey", "o_orderstatus"))


@query(
    "saved_marks",
    """select 'orders' as workflow, cast(max(o_orderkey) as varchar) as mark from orders union all
       select 'customers', cast(max(c_custkey) as varchar) from customer union all select 'none', null""",
)
def saved_marks(t: Tables) -> DataFrame:
    """Marks of two workflows, saved after an older one of each, and of one that never ran."""
    path = scratch_folder(t.spark, "marks")
    for now in (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)):
        for name, rows, key in (("orders", t.orders, "o_orderkey"), ("customers", t.customer, "c_custkey")):
            done = rows if now.day == 2 else rows.where(F.col(key) < 100)
            loads.write_mark(t.spark, path, name, loads.next_mark(done, key).first()["mark"], now)
    marks = [(name, loads.read_mark(t.spark, path, name)) for name in ("orders", "customers", "none")]
    return t.spark.createDataFrame(marks, "workflow string, mark string")


@query(
    "content_ids",
    """select md5(coalesce(length(event_type) || ':' || event_type, '-') || length(cast(user_id as varchar)) || ':'
                  || cast(user_id as varchar)) || '-'
              || cast(row_number() over (partition by event_type, user_id) as varchar) as row_id, event_type, user_id
       from (select case when event_type <> 'error' then event_type end as event_type, user_id from events)""",
)
def content_ids(t: Tables) -> DataFrame:
    """Events without their id and time: many rows are equal, and a fifth has no type."""
    kind = F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type")
    return plain(loads.content_id(t.events.select(kind, "user_id").repartition(7)))


@query(
    "asof_events",
    """with asked as (select event_id, user_id, ts from events where event_type = 'purchase'),
            known as (select user_id, ts, event_id as view_id, value from events where event_type = 'view')
       select a.event_id, k.view_id, k.value from asked a asof left join known k on a.user_id = k.user_id and a.ts >= k.ts""",
)
def asof_events(t: Tables) -> DataFrame:
    """The last view of the same user before each purchase."""
    views = t.events.where("event_type = 'view'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("view_id"), "value")
    bought = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return plain(asof_lookup(bought, views, ["user_id"], "ts", "at", ["view_id", "value"]).select("event_id", "view_id", "value"))


@query("preview")
def preview(t: Tables) -> DataFrame:
    """Any ten rows, so only their number is known."""
    return files.preview(t.orders)
