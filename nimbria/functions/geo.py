"""Geographic and calendar Column functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
EARTH_M = 6371229.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_KM) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a)))  # null stays null, which least() would not keep


def displacement_km(dlat: Column, dlon: Column, lat: Column, radius: float = EARTH_KM) -> Column:
    """The length of a displacement by degrees from ``lat``, its other end taken at ``lat`` + ``dlat``."""
    return haversine_km(lat, F.lit(0.0), lat + dlat, dlon, radius)


def cartesian(lat: Column, lon: Column, radius: float = EARTH_M) -> tuple[Column, Column, Column]:
    la, lo = F.radians(lat), F.radians(lon)
    return radius * F.cos(la) * F.cos(lo), radius * F.cos(la) * F.sin(lo), radius * F.sin(la)


def in_box(lat: Column, lon: Column, north: float, west: float, south: float, east: float) -> Column:
    """Inside a box; west > east wraps through the date line."""
    lon, west, east = F.pmod(lon, F.lit(360.0)), west % 360, east % 360
    across = lon.between(west, east) if west <= east else (lon >= west) | (lon <= east)
    return lat.between(south, north) & across


def normalise_angle(x: Column, positive: bool = True) -> Column:
    """x mod 360; the signed branch shifts by 180 degrees rather than recentring, as callers expect."""
    turned = F.pmod(x, F.lit(360.0))
    return turned if positive else turned - 180


def grid_index(lat: Column, lon: Column, north: float, west: float, dlat: float, dlon: float) -> tuple[Column, Column]:
    """Row and column of the regular grid cell that holds a point."""
    return F.floor((F.lit(north) - lat) / dlat), F.floor(F.pmod(lon - west, F.lit(360.0)) / dlon)


def overlap_spacing(radius: float, share: float) -> float:
    """Distance of the centres of two equal circles whose overlap is ``share`` of one circle's area, by bisection."""
    if not 0 <= share <= 1:
        raise ValueError("share must be between 0 and 1")

    def overlap(d: float) -> float:
        half = d / (2 * radius)
        return (2 * math.acos(half) - 2 * half * math.sqrt(max(0.0, 1 - half * half))) / math.pi

    low, high = 0.0, 2 * radius
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if overlap(middle) > share else (low, middle)
    return (low + high) / 2


def hours_between(first: Column, last: Column) -> Column:
    return F.timestamp_diff("HOUR", first, last)


def month_days(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))


def truncation_to_gaussian(truncation: int, order: int) -> int:
    """Gaussian number N of a spectral truncation for grid order 1 (linear), 2 (quadratic), 3 (cubic)."""
    return (truncation + 1) * (order + 1) // 4


def gaussian_to_truncation(n: int, order: int) -> int:
    return math.ceil(4 * n / (order + 1)) - 1
