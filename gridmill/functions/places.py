"""Places: points in text, distances, circles, grid and hexagon cells."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

KM_PER_DEGREE = 111.0
# The area of operation, in degrees.
LATITUDES, LONGITUDES = (-5.0, 5.0), (28.0, 42.0)


def point_part(wkt: Column, which: int) -> Column:
    """Longitude (0) or latitude (1) of a text POINT(x y)."""
    inner = F.regexp_extract(wkt, r"POINT\s*\((.*?)\)", 1)
    return F.get(F.split(F.trim(inner), r"\s+"), F.lit(which)).try_cast("double")


def valid_place(lat: Column, lon: Column) -> Column:
    return lat.between(*LATITUDES) & lon.between(*LONGITUDES) & ~((lat == 0) & (lon == 0))


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Planar, a degree counting ``KM_PER_DEGREE`` either way."""
    return F.sqrt(F.pow(lon1 - lon2, 2) + F.pow(lat1 - lat2, 2)) * KM_PER_DEGREE


def circle(lat: Column, lon: Column, radius_km: float, step: int = 10) -> Column:
    """A closed ring of points around a place."""
    r = radius_km / KM_PER_DEGREE
    angle = F.sequence(F.lit(0), F.lit(360), F.lit(step))
    return F.transform(angle, lambda a: F.struct((lon + r * F.cos(F.radians(a))).alias("lon"), (lat + r * F.sin(F.radians(a))).alias("lat")))


def hexagon(lat: Column, lon: Column, size: float) -> tuple[Column, Column]:
    """Column and row of the hexagon (pointed top, ``size`` degrees from centre to corner)
    whose centre is nearest: axial coordinates, rounded in the cube."""
    q = (lon * math.sqrt(3) / 3 - lat / 3) / size
    r = (lat * 2 / 3) / size
    s = -q - r
    rq, rr, rs = F.round(q), F.round(r), F.round(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    col = F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq)
    row = F.when(~((dq > dr) & (dq > ds)) & (dr > ds), -rq - rs).otherwise(rr)
    return col.cast("long"), row.cast("long")
