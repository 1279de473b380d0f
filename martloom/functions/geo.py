"""Distances on the sphere and grid cells in three-dimensional earth coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.keys import as_column

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: str | Column, lon1: str | Column, lat2: str | Column, lon2: str | Column) -> Column:
    """Great-circle distance in kilometres; NULL if a coordinate is missing."""
    phi1, phi2 = F.radians(as_column(lat1)), F.radians(as_column(lat2))
    half_lat = F.sin((phi1 - phi2) / 2)
    half_lon = F.sin((F.radians(as_column(lon1)) - F.radians(as_column(lon2))) / 2)
    chord = half_lat * half_lat + F.cos(phi1) * F.cos(phi2) * half_lon * half_lon
    # Rounding may lift opposite points just above one.
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.when(chord > 1, F.lit(1.0)).otherwise(chord)))


def unit_vector(lat: str | Column, lon: str | Column) -> Column:
    """Point on the unit sphere as (x, y, z)."""
    phi, lam = F.radians(as_column(lat)), F.radians(as_column(lon))
    return F.struct(
        (F.cos(phi) * F.cos(lam)).alias("x"), (F.cos(phi) * F.sin(lam)).alias("y"), F.sin(phi).alias("z")
    )


def chord_squared(a: Column, b: Column) -> Column:
    """Squared straight-line distance of two unit vectors; it orders points as the arc does."""
    dx, dy, dz = a["x"] - b["x"], a["y"] - b["y"], a["z"] - b["z"]
    return dx * dx + dy * dy + dz * dz


# A cell is one number, x * 2^42 + y * 2^21 + z, so that a step to a neighbour is an addition.
AXIS_STEPS = (1 << 42, 1 << 21, 1)

# Cells are never smaller than this, which keeps every axis within its 21 bits.
MIN_EDGE_KM = 0.01


def earth_cell(lat: str | Column, lon: str | Column, edge_km: float) -> Column:
    """Cell of a cubic grid laid over the globe.

    A straight line is never longer than the arc above it, so two points within ``edge_km``
    of each other always lie in the same cell or in touching ones, at the poles and across
    the date line too.
    """
    point = unit_vector(lat, lon)
    scale = F.lit(EARTH_RADIUS_KM / max(edge_km, MIN_EDGE_KM))
    x, y, z = (F.floor(point[axis] * scale) * F.lit(step) for axis, step in zip("xyz", AXIS_STEPS))
    return x + y + z


def vector_cell(vector: str, edge_km: float) -> Column:
    """Cell of the point that the column ``vector`` holds as ``unit_vector`` gives it."""
    scale = EARTH_RADIUS_KM / max(edge_km, MIN_EDGE_KM)
    axes = [f"floor({vector}.{axis} * {scale!r}D) * {step}L" for axis, step in zip("xyz", AXIS_STEPS)]
    return F.expr(" + ".join(axes))


def touching_cells(cell: str | Column, *, half: bool = False) -> Column:
    """Array of the cell itself and its 26 neighbours, or with ``half`` the 13 of them that follow it.

    Of two neighbours one follows the other, so half of them bring every pair together once.
    """
    dx, dy, dz = AXIS_STEPS
    moves = (-1, 0, 1)
    steps = [i * dx + j * dy + k * dz for i in moves for j in moves for k in moves]
    wanted = ", ".join(f"{step}L" for step in steps if step >= 0 or not half)
    return F.transform(F.expr(f"array({wanted})"), lambda step: as_column(cell) + step)
