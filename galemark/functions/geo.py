"""Distances on the globe."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0


def distance_km(lat: Column, lon: Column, to_lat: float, to_lon: float) -> Column:
    """Great-circle distance by the haversine formula."""
    dlat = F.radians(lat - F.lit(to_lat))
    dlon = F.radians(lon - F.lit(to_lon))
    h = (
        F.pow(F.sin(dlat / 2), F.lit(2.0))
        + F.cos(F.radians(F.lit(to_lat))) * F.cos(F.radians(lat))
        * F.pow(F.sin(dlon / 2), F.lit(2.0))
    )
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))
