"""Places and distances as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kwarta.config import PROVINCE_CENTRES

EARTH_RADIUS_KM = 6371.0


def _lookup(province: Column, axis: int) -> Column:
    pairs = []
    for name, centre in PROVINCE_CENTRES.items():
        pairs += [F.lit(name), F.lit(float(centre[axis]))]
    return F.try_element_at(F.create_map(*pairs), province)


def latitude(province: Column) -> Column:
    """Latitude of a province's centre; null for a place that is not in the table."""
    return _lookup(province, 0)


def longitude(province: Column) -> Column:
    return _lookup(province, 1)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; null if any coordinate is."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # Rounding can push the chord just above 1. (`least` would turn an unknown place into 1.)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.when(chord > 1, 1.0).otherwise(chord)))
