"""Distances on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["EARTH_RADIUS_KM", "haversine_km", "distance_to_point", "km_to_lat_deg", "km_to_lon_deg"]

# Fixed value (our choice; the reference's distance module is not published).
EARTH_RADIUS_KM = 6371.0


def _c(c) -> Column:
    if isinstance(c, (int, float)):
        return F.lit(float(c))
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km between two points given in degrees."""
    la1, lo1, la2, lo2 = (F.radians(_c(x)) for x in (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin((la2 - la1) / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2)
    return 2 * F.lit(EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def distance_to_point(lat, lon, lat0: float, lon0: float) -> Column:
    """Distance in km to a fixed centre."""
    return haversine_km(lat, lon, F.lit(float(lat0)), F.lit(float(lon0)))


def km_to_lat_deg(km: float) -> float:
    """Degrees of latitude that span ``km`` (exact on the sphere)."""
    import math
    return math.degrees(km / EARTH_RADIUS_KM)


def km_to_lon_deg(km: float, max_abs_lat: float) -> float:
    """Degrees of longitude that cover ``km`` everywhere up to latitude ``max_abs_lat``."""
    import math
    c = math.cos(math.radians(min(89.9, abs(max_abs_lat))))
    return math.degrees(km / (EARTH_RADIUS_KM * c))
