"""Great-circle distance and the box that bounds a circle."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371008.7714
_UNITS_M = {"m": 1.0, "km": 1000.0, "mi": 1609.344}


def metres(distance: str) -> float:
    """``"100km"`` -> 100000.0"""
    found = re.fullmatch(r"\s*([0-9]*\.?[0-9]+)\s*([a-z]+)\s*", distance.lower())
    if not found or found.group(2) not in _UNITS_M:
        raise ValueError(f"cannot read distance {distance!r}; use a number and one of {sorted(_UNITS_M)}")
    return float(found.group(1)) * _UNITS_M[found.group(2)]


def haversine_m(lat: Column, lon: Column, lat0: float, lon0: float) -> Column:
    half_dlat = F.radians(lat - F.lit(lat0)) / 2
    half_dlon = F.radians(lon - F.lit(lon0)) / 2
    a = F.pow(F.sin(half_dlat), 2) + F.cos(F.radians(lat)) * math.cos(math.radians(lat0)) * F.pow(
        F.sin(half_dlon), 2
    )
    return F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * (2 * EARTH_RADIUS_M)


def bounding_box(lat: Column, lon: Column, lat0: float, lon0: float, distance_m: float) -> Column:
    """Plain comparisons that hold for every point of the circle, so a scan can use them."""
    slack = 1e-6
    angle = distance_m / EARTH_RADIUS_M
    reach = math.degrees(angle) + slack
    box = (lat >= lat0 - reach) & (lat <= lat0 + reach)
    if lat0 + reach >= 90 or lat0 - reach <= -90:
        return box
    spread = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat0))))) + slack
    west, east = lon0 - spread, lon0 + spread
    if west < -180:
        return box & ((lon >= west + 360) | (lon <= east))
    if east > 180:
        return box & ((lon >= west) | (lon <= east - 360))
    return box & (lon >= west) & (lon <= east)
