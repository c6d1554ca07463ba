"""Coordinate Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088
KM_PER_DEG_LAT = math.pi * EARTH_RADIUS_KM / 180.0


def hemisphere_ns(lat: Column) -> Column:
    """N for strictly positive latitude, else S (0 reads as S)."""
    return F.when(lat > 0, F.lit("N")).otherwise(F.lit("S"))


def hemisphere_ew(lon: Column) -> Column:
    return F.when(lon > 0, F.lit("E")).otherwise(F.lit("W"))


def fmt_deg(x: Column, scale: int = 4) -> Column:
    """Absolute degrees with a fixed number of decimals."""
    return F.abs(x).cast(f"decimal(10,{scale})").cast("string")


def coordinate_text(lat: Column, lon: Column, scale: int = 4) -> Column:
    """``18.3711°N, 74.0992°W``."""
    return F.concat(fmt_deg(lat, scale), F.lit("°"), hemisphere_ns(lat), F.lit(", "),
                    fmt_deg(lon, scale), F.lit("°"), hemisphere_ew(lon))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = p2 - p1
    dlmb = F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def nautical_zone(lon: Column) -> Column:
    """Zone of the 15-degree sector around a longitude (east of Greenwich: ``Etc/GMT-n``)."""
    h = F.round(lon / 15).cast("int")
    return F.when(h == 0, F.lit("Etc/GMT")).when(h > 0, F.concat(F.lit("Etc/GMT-"), h.cast("string"))).otherwise(
        F.concat(F.lit("Etc/GMT+"), (-h).cast("string")))


def cell(x: Column, size_deg: float) -> Column:
    return F.floor(x / F.lit(size_deg)).cast("int")
