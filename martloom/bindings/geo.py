"""Events with coordinates computed from their id; nations as places with decimal-comma coordinates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.bindings.registry import Tables, plain, query
from martloom.functions.text import json_field
from martloom.operators.ranking import latest_per_key
from martloom.operators.spatial import assign_nearest
from martloom.plans import geo

ZONE = "Australia/Sydney"
PROCESSED = dt.datetime(2024, 2, 1)
KINDS = {"message": "view", "reaction": "click", "subscription": "purchase", "user": "signup"}

# Twelve places a degree and more apart; some of the coordinates have no short binary form.
PLACES_SQL = """
places as (
  select cast(n_nationkey as bigint) as place_id, n_name as city,
         cast(cast(-10.3 - n_nationkey as float) as double) as lat_city,
         cast(cast(113.7 + (n_nationkey * 7) % 25 as float) as double) as lng_city
  from nation)
"""
KM = """2 * 6371 * asin(sqrt(least(1.0, pow(sin((radians({a}) - radians({c})) / 2), 2)
        + cos(radians({a})) * cos(radians({c})) * pow(sin((radians({b}) - radians({d})) / 2), 2))))"""
DISTANCE = KM.format(a="lat", b="lon", c="lat_city", d="lng_city")
WIDE_SQL = f"""
with {PLACES_SQL},
located_all as (
  select *, case when event_id % 10 <> 9 then -10.0 - (event_id * 7 % 3000) / 100.0 end as lat,
         113.0 + (event_id * 13 % 4000) / 100.0 as lon, cast(ts as date) as date from events),
nearest as (
  select e.*, p.place_id, p.city, p.distance
  from located_all e left join lateral (
    select place_id, city, {DISTANCE} as distance from places where lat is not null
    order by distance, place_id limit 1) p on true)
"""
# A user's days are spread over three places, so that stays of several days occur.
STAYS_SQL = f"""
with {PLACES_SQL},
nearest as (
  select e.*, cast(ts as date) as date, p.place_id, p.city
  from events e join places p on p.place_id = e.event_id % 3),
days as (select distinct user_id, place_id, city, date from nearest),
runs as (
  select user_id, place_id, city, min(date) as run_start, max(date) as run_end, count(*) as count_days
  from (select *, date - cast(row_number() over (partition by user_id, place_id order by date) as integer) as anchor
        from days) group by user_id, place_id, city, anchor)
"""
HOME_SQL = """home as (
  select user_id, city as home_city from (
    select *, row_number() over (partition by user_id order by run_end desc, count_days desc, place_id desc) as n
    from runs where count_days >= 5) where n = 1)"""
TRAVEL_SQL = """travel as (
  select user_id, string_agg(city, ',' order by run_start, place_id) as travel_array, count(*) as travel_count
  from runs group by user_id)"""
LOCAL = "strftime(ts at time zone 'UTC' at time zone 'Australia/Sydney', '%Y-%m-%d %H:%M:%S.%f')"


def raw_places(t: Tables) -> DataFrame:
    key = F.col("n_nationkey")
    lat = F.concat(F.lit("-"), (key + 10).cast("string"), F.lit(",3"))
    lng = F.concat((key * 7 % 25 + 113).cast("string"), F.lit(",7"))
    return t.nation.select(key.alias("id"), F.col("n_name").alias("city"), lat.alias("lat"), lng.alias("lng"))


def places(t: Tables) -> DataFrame:
    return geo.clean_coordinates(raw_places(t))


def wide_events(t: Tables) -> DataFrame:
    """Events over a wide box; every tenth has no latitude."""
    key = F.col("event_id")
    return t.events.select("event_id", "user_id", "event_type", "ts").select(
        "event_id",
        "user_id",
        "event_type",
        "ts",
        F.when(key % 10 != 9, F.lit(-10.0) - (key * 7 % 3000) / 100.0).alias("lat"),
        (F.lit(113.0) + (key * 13 % 4000) / 100.0).alias("lon"),
        F.to_date("ts").alias("date"),
    )


def stay_events(t: Tables) -> DataFrame:
    """Events a little beside one of three places."""
    key = F.col("event_id") % 3
    return t.events.select("event_id", "user_id", "ts").select(
        "event_id",
        "user_id",
        "ts",
        (F.lit(-10.31) - key).alias("lat"),
        (F.lit(113.71) + (key * 7) % 25).alias("lon"),
        F.to_date("ts").alias("date"),
    )


def runs(t: Tables) -> DataFrame:
    return geo.stays(assign_nearest(stay_events(t), places(t), "event_id"))


@query("clean_coordinates", f"with {PLACES_SQL} select * from places")
def clean_coordinates(t: Tables) -> DataFrame:
    return plain(places(t))


@query("nearest_place", WIDE_SQL + "select event_id, place_id, city, round(distance, 3) as distance from nearest")
def nearest(t: Tables) -> DataFrame:
    located = assign_nearest(wide_events(t), places(t), "event_id")
    return plain(located.select("event_id", "place_id", "city", F.round("distance", 3).alias("distance")))


@query(
    "nearest_place_grid",
    WIDE_SQL + "select event_id, place_id, city, round(distance, 3) as distance from nearest",
)
def nearest_grid(t: Tables) -> DataFrame:
    """A coarser finest grid and cells cut into blocks of two places: the answer stays."""
    located = assign_nearest(wide_events(t), places(t), "event_id", first_km=400.0, block_rows=2)
    return plain(located.select("event_id", "place_id", "city", F.round("distance", 3).alias("distance")))


@query(
    "nearest_place_per_user",
    WIDE_SQL
    + """select user_id, event_id, place_id from (
           select *, row_number() over (partition by user_id order by distance nulls last, event_id) as n from nearest)
         where n = 1""",
)
def nearest_per_user(t: Tables) -> DataFrame:
    located = assign_nearest(wide_events(t), places(t), "event_id", partition_by="user_id")
    return plain(located.select("user_id", "event_id", "place_id"))


@query(
    "latest_place",
    WIDE_SQL
    + """select user_id, event_id, city from (
           select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from nearest)
         where n = 1""",
)
def latest_place(t: Tables) -> DataFrame:
    located = assign_nearest(wide_events(t), places(t), "event_id")
    return plain(latest_per_key(located, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "city"))


@query(
    "day_runs",
    STAYS_SQL
    + """select user_id, place_id, city, cast(run_start as varchar) as run_start, cast(run_end as varchar) as run_end,
         count_days from runs""",
)
def day_runs(t: Tables) -> DataFrame:
    return plain(runs(t))


@query("home_city", STAYS_SQL + f", {HOME_SQL} select * from home")
def home_city(t: Tables) -> DataFrame:
    return plain(geo.home_city(runs(t), min_days=5))


@query("travel_array", STAYS_SQL + f", {TRAVEL_SQL} select * from travel")
def travel_array(t: Tables) -> DataFrame:
    return plain(geo.travel_array(runs(t)))


@query("local_time", f"select event_id, {LOCAL} as local_time from events")
def local_time(t: Tables) -> DataFrame:
    return plain(geo.local_time(t.events, "ts", ZONE).select("event_id", "local_time"))


@query(
    "user_geo_mart",
    STAYS_SQL
    + f""", {HOME_SQL}, {TRAVEL_SQL}, actual as (
      select user_id, city as act_city, {LOCAL} as local_time from (
        select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from nearest)
      where n = 1)
    select user_id, act_city, home_city, travel_count, travel_array, local_time
    from actual left join travel using (user_id) left join home using (user_id)""",
)
def user_geo_mart(t: Tables) -> DataFrame:
    return plain(geo.user_geo_mart(stay_events(t), places(t), ZONE, min_days=5))


ZONE_SQL = """, zoned as (
  select cast(strftime(date, '%G') as bigint) as week_year, cast(strftime(date, '%V') as bigint) as week,
         year(date) as year, month(date) as month, place_id as zone_id, event_type
  from nearest where lat is not null),
weeks as (
  select week_year, week, zone_id, count(*) filter (event_type = 'view') as week_message,
         count(*) filter (event_type = 'click') as week_reaction,
         count(*) filter (event_type = 'purchase') as week_subscription,
         count(*) filter (event_type = 'signup') as week_user from zoned group by all),
months as (
  select year, month, zone_id, count(*) filter (event_type = 'view') as month_message,
         count(*) filter (event_type = 'click') as month_reaction,
         count(*) filter (event_type = 'purchase') as month_subscription,
         count(*) filter (event_type = 'signup') as month_user from zoned group by all)
select * from (select distinct week_year, week, year, month, zone_id from zoned)
join weeks using (week_year, week, zone_id) join months using (year, month, zone_id)
"""


@query("zone_activity", WIDE_SQL + ZONE_SQL)
def zone_activity(t: Tables) -> DataFrame:
    return plain(geo.zone_activity(wide_events(t), places(t), KINDS))


PAIRS_SQL = f"""
with spots as (
  select user_id, event_id, ts, cast(props ->> '$.k' as bigint) as k, event_type,
         -33.0 + (event_id * 37 % 1000) / 10000.0 as lat, 151.0 + (event_id * 91 % 1000) / 10000.0 as lon
  from events),
seen as (
  select user_id, lat, lon, event_id % 5 as zone_id, {LOCAL} as local_time from (
    select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from spots) where n = 1),
subs as (select distinct k as channel, user_id from spots),
wrote as (select user_id as sender, k as receiver from spots where event_type = 'click'),
shared as (
  select distinct a.user_id as u1, b.user_id as u2
  from subs a join subs b on a.channel = b.channel and a.user_id < b.user_id)
select u1 as user_left, u2 as user_right, '2024-02-01 00:00:00.000000' as processed_dttm, l.zone_id, l.local_time
from shared join seen l on u1 = l.user_id join seen r on u2 = r.user_id
where {KM.format(a="l.lat", b="l.lon", c="r.lat", d="r.lon")} <= 1
  and not exists (select 1 from wrote where (sender = u1 and receiver = u2) or (sender = u2 and receiver = u1))
"""


@query("recommend_pairs", PAIRS_SQL)
def recommend_pairs(t: Tables) -> DataFrame:
    key = F.col("event_id")
    spots = t.events.select(
        "user_id",
        "event_id",
        "ts",
        "event_type",
        json_field("props", "k").cast("long").alias("k"),
        (F.lit(-33.0) + (key * 37 % 1000) / 10000.0).alias("lat"),
        (F.lit(151.0) + (key * 91 % 1000) / 10000.0).alias("lon"),
    )
    seen = latest_per_key(spots, ["user_id"], ["ts", "event_id"]).withColumn("zone_id", key % 5)
    seen = geo.local_time(seen, "ts", ZONE).select("user_id", "lat", "lon", "zone_id", "local_time")
    subs = spots.select(F.col("k").alias("channel"), "user_id")
    wrote = spots.where("event_type = 'click'").select(F.col("user_id").alias("sender"), F.col("k").alias("receiver"))
    return plain(geo.recommend_pairs(subs, seen, wrote, PROCESSED))
