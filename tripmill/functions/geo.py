"""Distances and grid cells on latitude and longitude in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km, not rounded."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    sin_lat = F.sin((phi2 - phi1) / 2)
    sin_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    a = sin_lat * sin_lat + F.cos(phi1) * F.cos(phi2) * sin_lon * sin_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def in_latitude(x: Column) -> Column:
    return x.between(-90.0, 90.0)


def in_longitude(x: Column) -> Column:
    return x.between(-180.0, 180.0)


def grid_cell(lat: Column, lon: Column, cells_per_degree: int = 100) -> Column:
    """Whole-number id of the square grid cell a point lies in."""
    n = F.lit(float(cells_per_degree))
    row = F.floor((lat + 90.0) * n)
    column = F.floor((lon + 180.0) * n)
    return row * F.lit(360 * cells_per_degree + 1) + column
