from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: kilometres.
EARTH_RADIUS_KM = 6371


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance between two points given in degrees."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_dlon), 2)
    return 2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(a), F.sqrt(1 - a))
