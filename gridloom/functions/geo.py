"""Coordinates and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def lat_of(pair: Column) -> Column:
    """Latitude of ``lat,lon`` text."""
    return F.split_part(pair, F.lit(","), F.lit(1)).cast("double")


def lon_of(pair: Column) -> Column:
    """Longitude of ``lat,lon`` text."""
    return F.split_part(pair, F.lit(","), F.lit(2)).cast("double")


def pair_text(lat: Column, lon: Column) -> Column:
    return F.concat_ws(",", lat.cast("string"), lon.cast("string"))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * (
        half_lon * half_lon
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))
