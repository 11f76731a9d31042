"""Distances on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def _col(x: Column | str | float) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(float(x))


def haversine_km(lat_a, lon_a, lat_b, lon_b) -> Column:
    """Great-circle distance by the arcsine form; arguments are columns, names or numbers in degrees."""
    fa, la, fb, lb = (F.radians(_col(x)) for x in (lat_a, lon_a, lat_b, lon_b))
    h = F.pow(F.sin((fb - fa) / 2), 2) + F.cos(fa) * F.cos(fb) * F.pow(F.sin((lb - la) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(h))
