from __future__ import annotations

import math
import random

import pytest

from conftest import rows
from martloom.functions.geo import haversine_km
from martloom.operators.spatial import assign_nearest, pairs_sharing_groups, pairs_within_radius
from pyspark.sql import functions as F

POINTS = "channel int, user_id int, lat double, lon double"


def km(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    dl = math.radians(lon1) - math.radians(lon2)
    a = math.sin((p1 - p2) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(min(1.0, a)))


def test_haversine_nulls_and_opposite_points(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (None, 0.0, 1.0, 1.0)], "a double, b double, c double, d double")
    got = [r["x"] for r in df.select(haversine_km("a", "b", "c", "d").alias("x")).collect()]
    assert got[0] == pytest.approx(math.pi * 6371) and got[1] is None


def scattered(n, seed):
    """Points in two places, at the pole and across the date line, a third of them in one channel."""
    rng = random.Random(seed)
    centers = [(-33.0, 151.0), (89.999, 10.0), (0.0, 180.0), (0.0, -180.0)]
    out = []
    for i in range(n):
        lat, lon = rng.choice(centers)
        lat = max(-90.0, min(90.0, lat + rng.uniform(-0.02, 0.02)))
        lon = lon + rng.uniform(-0.02, 0.02)
        out.append((0 if i % 3 == 0 else rng.randrange(4), i, lat, lon))
    return out


@pytest.mark.parametrize("block_rows", [5, 20_000])
def test_pairs_equal_brute_force(spark, block_rows):
    data = scattered(240, 1)
    df = spark.createDataFrame(data, POINTS)
    got = pairs_within_radius(df, "channel", "user_id", 1.0, block_rows=block_rows)
    want = {
        (a[1], b[1])
        for a in data
        for b in data
        if a[0] == b[0] and a[1] < b[1] and km(a[2], a[3], b[2], b[3]) <= 1.0
    }
    found = [(r["left"], r["right"]) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want and want


def test_pair_in_two_groups_comes_once(spark):
    data = [(c, u, -33.0, 151.0) for c in (1, 2) for u in (1, 2)]
    got = pairs_within_radius(spark.createDataFrame(data, POINTS), "channel", "user_id", 1.0)
    assert rows(got, "left", "right") == [(1, 2)]


def test_crowd_at_one_point_gives_every_pair(spark):
    data = [(1, u, -33.0, 151.0) for u in range(60)]
    got = pairs_within_radius(spark.createDataFrame(data, POINTS), "channel", "user_id", 1.0, block_rows=7)
    assert got.count() == 60 * 59 // 2


@pytest.mark.parametrize("groups_of", [lambda u: range(u % 3, 90 + u % 3), lambda u: [u // 2, -(u % 25)]], ids=["common", "rare"])
def test_pairs_with_a_common_group_meet_once(spark, groups_of):
    """More groups than the mask has bits, and groups of few: cells meet as a whole, or group by group."""
    spots = [(u, lat, lon, f"at {u}") for _, u, lat, lon in scattered(240, 1)]
    groups = {u: set(groups_of(u)) for u, *_ in spots}
    members = [(g, u) for u, own in groups.items() for g in own]
    points = spark.createDataFrame(spots, "user_id int, lat double, lon double, note string")
    near = {(a[0], b[0]) for a in spots for b in spots if a[0] < b[0] and groups[a[0]] & groups[b[0]] and km(*a[1:3], *b[1:3]) <= 1.0}
    ruled_out = set(sorted(near)[::3])
    apart = spark.createDataFrame([(a, b) if a % 2 else (b, a) for a, b in ruled_out], "left int, right int")
    got = pairs_sharing_groups(
        points, spark.createDataFrame(members, "channel int, user_id int"), "user_id", "channel", 1.0,
        carry=["note"], without=apart, block_rows=9,
    )
    assert near - ruled_out
    assert rows(got, "left", "right", "note") == sorted([(a, b, f"at {a}") for a, b in near - ruled_out], key=repr)


@pytest.mark.parametrize(("first_km", "block_rows"), [(300.0, 20_000), (0.5, 3), (9_000.0, 4), (50_000.0, 20_000)])
def test_nearest_equals_brute_force(spark, first_km, block_rows):
    rng = random.Random(5)
    places = [(i, f"c{i}", rng.uniform(-89, 89), rng.uniform(-180, 180)) for i in range(30)]
    # A crowd of places a few metres apart, the poles and both sides of the date line.
    places += [(100 + i, "crowd", -33.0 + i * 1e-5, 151.0) for i in range(40)] + [(200, "pole", 90.0, 0.0), (201, "line", 0.0, -179.99)]
    events = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(200)]
    events += [(300 + i, -33.0 + rng.uniform(-3, 3), 151.0 + rng.uniform(-3, 3)) for i in range(60)]
    events += [(400, -33.0, 151.0), (401, 90.0, 77.0), (402, 0.0, 179.99), (403, -90.0, 5.0), (999, None, 10.0)]
    got = assign_nearest(
        spark.createDataFrame(events, "event_id int, lat double, lon double"),
        spark.createDataFrame(places, "place_id int, city string, lat_city double, lng_city double"),
        "event_id",
        first_km=first_km,
        block_rows=block_rows,
    )
    found = {r["event_id"]: (r["place_id"], r["distance"]) for r in got.collect()}
    assert found.pop(999) == (None, None)
    for i, lat, lon in events[:-1]:
        best = min((km(lat, lon, p[2], p[3]), p[0]) for p in places)
        assert found[i][0] == best[1] and found[i][1] == pytest.approx(best[0])


def test_nearest_with_repeated_and_null_ids(spark):
    places = spark.createDataFrame([(1, "A", 10.0, 10.0), (2, "B", 50.0, 50.0)], "place_id int, city string, lat_city double, lng_city double")
    events = spark.createDataFrame([(1, 10.0, 10.0), (1, 50.0, 50.0), (None, 10.0, 10.0), (2, None, None)], "event_id int, lat double, lon double")
    got = assign_nearest(events, places, "event_id")
    assert rows(got, "event_id", "lat", "city") == [(1, 10.0, "A"), (1, 50.0, "B"), (2, None, None), (None, 10.0, "A")]


def test_nearest_keeps_one_plan_beyond_two_thousand_places(spark):
    grid = [(i, f"c{i}", (i % 60) - 30.0, (i // 60) - 20.0) for i in range(2400)]
    places = spark.createDataFrame(grid, "place_id int, city string, lat_city double, lng_city double")
    events = spark.createDataFrame([(1, 0.2, 0.1), (1, -29.9, 19.2), (None, 0.2, 0.1)], "event_id int, lat double, lon double")
    got = assign_nearest(events, places, "event_id")
    near = lambda lat, lon: min(grid, key=lambda p: (km(lat, lon, p[2], p[3]), p[0]))[1]
    found = {(r.lat, r.lon): r.city for r in got.collect()}
    assert found == {(0.2, 0.1): near(0.2, 0.1), (-29.9, 19.2): near(-29.9, 19.2)} and got.count() == 3


def test_nearest_starts_no_job_and_writes_nothing(spark):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    places = spark.createDataFrame([(1, "A", 10.0, 10.0)], "place_id int, city string, lat_city double, lng_city double")
    events = spark.createDataFrame([(1, 10.0, 10.0)], "event_id int, lat double, lon double")
    located = assign_nearest(events, places, "event_id")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before
    assert assign_nearest(events, places.limit(0), "event_id").first()["city"] is None and located.first()["city"] == "A"
