"""Geo marts: home city and travels, zone activity, recommendation of nearby users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.dates import iso_week, iso_year, local_time as to_local_time
from martloom.functions.text import comma_decimal
from martloom.operators.runs import consecutive_day_runs
from martloom.operators.spatial import assign_nearest, pairs_sharing_groups

# Fixed value: shortest stay in days that makes a home city.
HOME_DAYS = 27

# Counted column prefix and event type of the zone mart.
ZONE_EVENTS = {
    "message": "message",
    "reaction": "reaction",
    "subscription": "subscription",
    "user": "registration",
}


def clean_coordinates(places: DataFrame) -> DataFrame:
    """Places with ``lat`` and ``lng`` in decimal-comma text as ``lat_city`` and ``lng_city``."""
    return (
        places.withColumn("lat", comma_decimal("lat"))
        .withColumn("lng", comma_decimal("lng"))
        .withColumnsRenamed({"id": "place_id", "lat": "lat_city", "lng": "lng_city"})
    )


STAY_KEYS = ["user_id", "place_id", "city"]


def stays(located: DataFrame) -> DataFrame:
    """Runs of consecutive days per user and place."""
    return consecutive_day_runs(located, STAY_KEYS, "date")


def _stay() -> Column:
    """Stays in the order a user made them."""
    return F.struct("run_start", "place_id", "city")


def _newest() -> Column:
    """Stays are compared by their last day; the longer stay wins a tie."""
    return F.struct("run_end", "count_days", "place_id")


def home_city(runs: DataFrame, min_days: int = HOME_DAYS) -> DataFrame:
    """City of each user's most recent stay of at least ``min_days`` days."""
    homes = runs.where(F.col("count_days") >= min_days)
    return homes.groupBy("user_id").agg(F.max_by("city", _newest()).alias("home_city"))


def travel_array(runs: DataFrame) -> DataFrame:
    """Cities in the order of the stays, and their number.

    A user has at most one stay per place and day, so the list is bounded by the calendar.
    """
    ordered = F.array_sort(F.collect_list(_stay()))
    return (
        runs.groupBy("user_id")
        .agg(ordered.alias("_stays"))
        .select(
            "user_id",
            F.col("_stays.city").alias("travel_array"),
            F.size("_stays").alias("travel_count"),
        )
    )


def local_time(events: DataFrame, ts: str, tz: str | Column) -> DataFrame:
    """Adds the local time of an event."""
    return events.withColumn("local_time", to_local_time(ts, tz))


def user_geo_mart(
    messages: DataFrame,
    places: DataFrame,
    tz: str | Column,
    *,
    min_days: int = HOME_DAYS,
) -> DataFrame:
    """Per user: actual and home city, travels, and local time of the latest event.

    ``messages`` has ``event_id``, ``user_id``, ``lat``, ``lon``, ``ts`` and ``date``. Events
    are located once and reduced to days and then to stays, which carry their latest event
    along; every column of the mart is an aggregate over a user's stays, with no join.
    """
    located = assign_nearest(messages, places, "event_id")
    runs = consecutive_day_runs(
        located.withColumn("_last", F.struct("ts", "event_id")), STAY_KEYS, "date", latest="_last"
    )
    known = F.col("place_id").isNotNull()
    return (
        runs.groupBy("user_id")
        .agg(
            F.max_by("city", "_last").alias("act_city"),
            F.max_by("city", F.when(known & (F.col("count_days") >= min_days), _newest())).alias("home_city"),
            F.count_if(known).alias("travel_count"),
            F.array_sort(F.collect_list(F.when(known, _stay()))).alias("_stays"),
            F.max("_last").alias("_last"),
        )
        .select(
            "user_id",
            "act_city",
            "home_city",
            F.when(F.col("travel_count") > 0, F.col("travel_count")).alias("travel_count"),
            F.when(F.col("travel_count") > 0, F.col("_stays.city")).alias("travel_array"),
            to_local_time("_last.ts", tz).alias("local_time"),
        )
    )


def zone_activity(
    events: DataFrame, places: DataFrame, event_types: dict[str, str] = ZONE_EVENTS
) -> DataFrame:
    """Events of each type per zone, for every week and month, side by side.

    ``events`` has ``event_id``, ``event_type``, ``lat``, ``lon`` and ``date``. Events are
    counted per zone, week and month first; the windows then run over these few counts.
    """
    located = assign_nearest(events.where("lat is not null"), places, "event_id")
    periods = located.select(
        iso_year("date").alias("week_year"),
        iso_week("date").alias("week"),
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.col("place_id").alias("zone_id"),
        "event_type",
    )
    keys = ["week_year", "week", "year", "month", "zone_id"]
    counts = periods.groupBy(*keys).agg(
        *[F.count_if(F.col("event_type") == kind).alias(name) for name, kind in event_types.items()]
    )
    by_week = Window.partitionBy("week_year", "week", "zone_id")
    by_month = Window.partitionBy("year", "month", "zone_id")
    return counts.select(
        *keys,
        *[F.sum(name).over(by_week).alias(f"week_{name}") for name in event_types],
        *[F.sum(name).over(by_month).alias(f"month_{name}") for name in event_types],
    )


def recommend_pairs(
    subscriptions: DataFrame,
    last_seen: DataFrame,
    messages: DataFrame,
    processed_at: object,
    radius_km: float = 1.0,
) -> DataFrame:
    """Pairs of users in a common channel, at most ``radius_km`` apart, that never wrote to each other.

    ``subscriptions``: ``channel``, ``user_id``. ``last_seen``: one row per user with ``lat``,
    ``lon``, ``zone_id`` and ``local_time``. ``messages``: ``sender``, ``receiver``. A message in
    either direction rules a pair out. Zone and local time are those of the left user. The pairs are as many as the
    rule gives, by nature with the square of the users of one place; none is met twice or shuffled.
    """
    wrote = messages.select(F.col("sender").alias("left"), F.col("receiver").alias("right")).dropna()
    carry = ["zone_id", "local_time"]
    near = pairs_sharing_groups(last_seen, subscriptions, "user_id", "channel", radius_km, carry=carry, without=wrote)
    return near.select(
        F.col("left").alias("user_left"),
        F.col("right").alias("user_right"),
        F.lit(processed_at).alias("processed_dttm"),
        "zone_id",
        "local_time",
    )
