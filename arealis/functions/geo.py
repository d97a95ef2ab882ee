"""Distances as Column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: mean Earth radius in metres.
EARTH_RADIUS_M = 6_371_000.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres between points given in degrees."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    half_lat = F.sin((p2 - p1) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    h = half_lat * half_lat + F.cos(p1) * F.cos(p2) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def unit_sphere(lat: Column, lon: Column) -> list[Column]:
    """Point on the unit sphere: straight-line order there is great-circle order."""
    p, q = F.radians(lat), F.radians(lon)
    return [F.cos(p) * F.cos(q), F.cos(p) * F.sin(q), F.sin(p)]
