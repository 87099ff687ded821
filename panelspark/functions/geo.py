"""Great-circle distance (P38, used by the kNN imputation J08)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Central angle in radians between two points given in degrees."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dlat = p2 - p1
    dlon = F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return 2 * F.asin(F.sqrt(F.least(F.lit(1.0), a)))
