"""Distances on the globe as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: earth radius in km and miles per metre
EARTH_KM = 6371.0
MILES_PER_METRE = 0.000621371


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = (F.sin(dlat) * F.sin(dlat)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon))
    return 2 * F.asin(F.least(F.lit(1.0), F.sqrt(a))) * EARTH_KM * 1000 * MILES_PER_METRE


def coordinate(c: Column) -> Column:
    """Micro-degree text such as 41234567N to degrees (N and E positive)."""
    value = F.regexp_replace(c, ".$", "").try_cast("double") / 1000000
    return F.when(c.rlike("[NE]$"), value).otherwise(-value)
