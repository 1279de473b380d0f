"""Nearest place and pairs within a radius."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.geo import (
    EARTH_RADIUS_KM,
    chord_squared,
    earth_cell,
    haversine_km,
    touching_cells,
    unit_vector,
    vector_cell,
)
from martloom.operators.lineage import cut_lineage
from martloom.operators.ranking import first_per_key

# Rows of a (group, cell) that one task meets on either side of the pair join.
PAIR_BLOCK_ROWS = 20_000

# Keys of a cell that meet as many others in one task, where a cell meets as a whole.
CELL_BLOCK_ROWS = 4_000

# The largest groups have a bit each in a key's mask.
MASK_BITS = 63

# Places of a cell that one task compares a coordinate pair with.
PLACE_BLOCK_ROWS = 20_000


def assign_nearest(
    events: DataFrame,
    places: DataFrame,
    event_id: str,
    *,
    partition_by: str | None = None,
    first_km: float = 5.0,
    block_rows: int = PLACE_BLOCK_ROWS,
) -> DataFrame:
    """Adds ``place_id``, ``city`` and ``distance`` of the nearest place to each event.

    ``events`` has ``lat`` and ``lon``; ``places`` has ``place_id``, ``city``, ``lat_city`` and ``lng_city``. Events
    without coordinates get NULLs; ids may repeat or be NULL. Equal distances go to the smaller ``place_id``. With
    ``partition_by`` only the row closest to any place is kept per value of that column.

    Distinct coordinates, not events, look for their place, so a crowd at one spot is one row. One plan for any
    number of places, and nothing runs before the caller's own action.
    """
    found = _nearest(events.select("lat", "lon"), places, _edges(first_km), block_rows)
    located = events.join(found, ["lat", "lon"], "left").select(*events.columns, "place_id", "city", "distance")
    if partition_by is None:
        return located
    return first_per_key(located, [partition_by], [F.col("distance").asc_nulls_last(), F.col(event_id)])


def _edges(first_km: float) -> list[float]:
    """Edges of the pyramid's grids in km, each four times the last, until all of the globe touches."""
    edges = [first_km]
    while edges[-1] < 2 * EARTH_RADIUS_KM:
        edges.append(edges[-1] * 4)
    return edges


def _cells(vector: str, edges: list[float]) -> Column:
    """The cell of a point in each grid, in the order of the grids."""
    return F.array(*[vector_cell(vector, edge) for edge in edges])


def _nearest(spots: DataFrame, places: DataFrame, edges: list[float], block_rows: int) -> DataFrame:
    """(lat, lon, place_id, city, distance): exact nearest place of each distinct coordinate pair.

    The places alone make a pyramid: for every edge, the cells with a place in one of their touching cells, and one
    such place. A coordinate pair meets the cells it lies in, one an edge, and the closest of their places bounds its
    distance. No place within this bound lies outside the touching cells of the finest grid whose edge is not below
    the bound, so a second join in this one grid meets all places that can win.

    A cell with many places is cut into blocks that meet a coordinate pair in different tasks. Places are compared by
    the squared chord in space; only the winner's distance is worked out.
    """
    targets = places.select("place_id", "city", "lat_city", "lng_city", unit_vector("lat_city", "lng_city").alias("_point"))
    own = targets.select("*", F.posexplode(_cells("_point", edges)).alias("level", "_own"))
    near = own.select(*targets.columns, "level", F.explode(touching_cells("_own")).alias("cell"))
    pyramid = near.groupBy("level", "cell").agg(
        F.min(F.struct("place_id", "_point")).alias("_some"),
        F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("_blocks"),
    )
    known = spots.where("lat is not null and lon is not null").distinct().withColumn("_here", unit_vector("lat", "lon"))
    met = known.select("*", F.posexplode(_cells("_here", edges)).alias("level", "cell")).join(pyramid, ["level", "cell"])
    chord = chord_squared(F.col("_here"), F.col("_some._point"))
    bound = F.sqrt("_chord") * F.lit(EARTH_RADIUS_KM * (1 + 1e-9))
    level = F.coalesce(*[F.when(bound <= edge, F.lit(i)) for i, edge in enumerate(edges)], F.lit(len(edges) - 1))
    asked = (
        met.groupBy("lat", "lon")
        .agg(F.min(chord).alias("_chord"), F.collect_list(F.struct("level", "cell", "_blocks")).alias("_cells"))
        .withColumn("_level", level)
        .select("lat", "lon", F.explode(F.filter("_cells", lambda c: c["level"] == F.col("_level"))).alias("_at"))
        .select("lat", "lon", "_at.level", "_at.cell", F.explode(F.sequence(F.lit(0), F.col("_at._blocks") - 1)).alias("_block"))
        .withColumn("_here", unit_vector("lat", "lon"))
    )
    in_block = near.join(pyramid.where("_blocks > 1").select("level", "cell", "_blocks"), ["level", "cell"], "left").withColumn(
        "_block", F.coalesce(F.pmod(F.xxhash64("place_id"), F.col("_blocks")).cast("int"), F.lit(0))
    )
    apart = chord_squared(F.col("_here"), F.col("_point")).alias("chord")
    return (
        asked.join(in_block.drop("_blocks"), ["level", "cell", "_block"])
        .groupBy("lat", "lon")
        .agg(F.min(F.struct(apart, "place_id", "city", "lat_city", "lng_city")).alias("_best"))
        .select(
            "lat",
            "lon",
            "_best.place_id",
            "_best.city",
            haversine_km("lat", "lon", "_best.lat_city", "_best.lng_city").alias("distance"),
        )
    )


def pairs_within_radius(
    points: DataFrame, group: str, key: str, radius_km: float, *, block_rows: int = PAIR_BLOCK_ROWS
) -> DataFrame:
    """Pairs ``(left, right, distance)`` with ``left < right`` that share a group and lie within the radius.

    ``points`` has ``group``, ``key``, ``lat`` and ``lon``, one row per group and key. Candidates
    meet on (group, grid cell): one side visits its own cell and the neighbours that follow it, the
    other stays in its own, so two points meet in one cell. A cell with more than ``block_rows`` rows is cut into blocks on both sides, and the
    blocks meet in different tasks.
    """
    placed = (
        points.where("lat is not null and lon is not null")
        .select(F.col(group).alias("_group"), F.col(key).alias("_key"), "lat", "lon")
        .withColumn("_cell", earth_cell("lat", "lon", radius_km))
    )
    crowded = (
        placed.groupBy("_group", "_cell")
        .agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("_blocks"))
        .where("_blocks > 1")
    )

    def blocks(side: DataFrame) -> DataFrame:
        own = F.pmod(F.xxhash64("_key"), F.col("_blocks")).cast("int")
        return (
            side.join(crowded, ["_group", "_cell"], "left")
            .withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
            .withColumn("_own", own)
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        )

    moved = placed.withColumn("_home", F.col("_cell")).withColumn("_cell", F.explode(touching_cells("_home", half=True)))
    left = blocks(moved).select(
        "_group", "_cell", "_home", F.col("_own").alias("_l"), F.col("_other").alias("_r"),
        F.col("_key").alias("left"), F.col("lat").alias("_lat1"), F.col("lon").alias("_lon1"),
    )
    right = blocks(placed).select(
        "_group", "_cell", F.col("_other").alias("_l"), F.col("_own").alias("_r"),
        F.col("_key").alias("right"), F.col("lat").alias("_lat2"), F.col("lon").alias("_lon2"),
    )
    return (
        left.join(right, ["_group", "_cell", "_l", "_r"])
        .where((F.col("_cell") != F.col("_home")) | (F.col("left") < F.col("right")))
        .withColumn("distance", haversine_km("_lat1", "_lon1", "_lat2", "_lon2").cast("float"))
        .where(F.col("distance") <= radius_km)
        .select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right"), "distance")
        .distinct()
    )


def pairs_sharing_groups(
    points: DataFrame,
    members: DataFrame,
    key: str,
    group: str,
    radius_km: float,
    *,
    carry: Sequence[str] = (),
    without: DataFrame | None = None,
    block_rows: int = CELL_BLOCK_ROWS,
) -> DataFrame:
    """Pairs ``(left, right)`` with ``left < right`` that lie within the radius and have a group in common.

    ``points``: ``key``, ``lat``, ``lon`` and the columns ``carry``, one row per key; ``members``: ``group``, ``key``.
    The result carries the columns of the left key. ``without`` are pairs (``left``, ``right``, in either order) to leave out.

    Two keys with many common groups would meet once in each. So a grid cell meets as a whole or group by group,
    whichever makes fewer candidates. As a whole a pair meets once and needs no distinct, and nothing but the keys is
    shuffled: a key brings its groups along (a bit for each of the largest, the others in a list) and the near keys it
    is not to be paired with.
    """
    joined = members.select(F.col(group).alias("_group"), F.col(key).alias("_key")).dropna().distinct()
    sizes = joined.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"))
    largest = sizes.orderBy(F.desc("_n"), "_group").limit(MASK_BITS).agg(F.collect_list("_group").alias("_largest"))
    ranks = largest.select(F.posexplode("_largest").alias("_rank", "_group"))
    sets = (
        joined.join(ranks, "_group", "left")
        .groupBy("_key")
        .agg(
            F.coalesce(F.sum(F.expr("shiftleft(1L, _rank)")), F.lit(0)).alias("_mask"),
            F.collect_list(F.when(F.col("_rank").isNull(), F.col("_group"))).alias("_rest"),
            F.collect_list("_group").alias("_groups"),
        )
    )
    located = points.where("lat is not null and lon is not null").select(F.col(key).alias("_key"), "lat", "lon", *carry)
    placed = located.join(sets, "_key").withColumn("_cell", earth_cell("lat", "lon", radius_km))
    placed = cut_lineage(placed.withColumn("_here", unit_vector("lat", "lon")))
    # A straight line is not longer than the arc: a cheap test before the distance itself.
    limit = F.lit((radius_km / EARTH_RADIUS_KM) ** 2 * (1 + 1e-6))
    if without is None:
        placed = placed.withColumn("_not", F.lit(None).cast("array<string>"))
    else:
        spots = placed.select("_key", "_here")
        apart = without.select(F.col("left").alias("_key"), F.col("right").alias("_other"))
        apart = apart.union(apart.select("_other", "_key")).distinct().join(spots, "_key")
        apart = apart.join(spots.select(F.col("_key").alias("_other"), F.col("_here").alias("_there")), "_other")
        apart = apart.where(chord_squared(F.col("_here"), F.col("_there")) <= limit)
        placed = placed.join(apart.groupBy("_key").agg(F.collect_list("_other").alias("_not")), "_key", "left")

    def crowds(on: list[str], rows: DataFrame) -> DataFrame:
        """Keys at home in a cell, and those that visit it from there and from the cells before it."""
        home = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
        visits = home.withColumn("_cell", F.explode(touching_cells("_cell", half=True))).withColumnRenamed("_n", "_v")
        met = visits.groupBy(*on).agg(F.sum("_v").alias("_v"))
        return home.join(met, on).withColumn("_cost", F.col("_n").cast("double") * F.col("_v"))

    apart_cells = crowds(["_cell"], placed.select("_cell"))
    grouped = crowds(["_cell", "_group"], placed.select("_cell", F.explode("_groups").alias("_group")))
    by_group = grouped.groupBy("_cell").agg(F.sum("_cost").alias("_by_group"))
    cells = apart_cells.join(by_group, "_cell").withColumn("_whole", F.col("_cost") <= F.col("_by_group"))
    blocks = F.ceil(F.col("_n") / block_rows).cast("int").alias("_blocks")
    whole = cells.where("_whole").select("_cell", blocks)
    parted = grouped.join(cells.where(~F.col("_whole")).select("_cell"), "_cell").select("_cell", "_group", blocks)

    def meet(rows: DataFrame, cut: DataFrame, on: list[str]) -> DataFrame:
        facts = ["_key", "lat", "lon", "_here", "_mask", "_rest", *carry]
        own = F.pmod(F.xxhash64("_key"), F.col("_blocks")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
        moved = rows.withColumn("_home", F.col("_cell")).withColumn("_cell", F.explode(touching_cells("_home", half=True)))
        left = moved.join(cut, on).select(*on, "_home", "_not", own.alias("_l"), other.alias("_r"), *[F.col(c).alias(f"_a_{c}") for c in facts])
        right = rows.join(cut, on).select(*on, other.alias("_l"), own.alias("_r"), *[F.col(c).alias(f"_b_{c}") for c in facts])
        pairs = left.join(right.hint("merge"), [*on, "_l", "_r"])  # few rows make many pairs: never from one task
        a, b = F.col("_a__key"), F.col("_b__key")
        near = (chord_squared(F.col("_a__here"), F.col("_b__here")) <= limit) & (
            haversine_km("_a_lat", "_a_lon", "_b_lat", "_b_lon").cast("float") <= radius_km
        )
        share = (F.col("_a__mask").bitwiseAND(F.col("_b__mask")) != 0) | F.arrays_overlap("_a__rest", "_b__rest")
        allowed = F.col("_not").isNull() | ~F.array_contains("_not", b)
        once = pairs.where(((F.col("_cell") != F.col("_home")) | (a < b)) & near & share & allowed)
        return once.select(
            F.least(a, b).alias("left"),
            F.greatest(a, b).alias("right"),
            *[F.when(a < b, F.col(f"_a_{c}")).otherwise(F.col(f"_b_{c}")).alias(c) for c in carry],
        )

    as_whole = meet(placed, whole, ["_cell"])
    in_groups = meet(placed.withColumn("_group", F.explode("_groups")), parted, ["_cell", "_group"])
    return as_whole.unionByName(in_groups.distinct())
