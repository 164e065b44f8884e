"""Coordinates."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
METRES_A_DEGREE = EARTH_M * math.pi / 180
CELL = 1000  # cells a degree


def distance_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance (haversine)."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def cell(c: Column) -> Column:
    return F.floor(c * CELL)


def place_key(street: Column, town: Column, country: str = "Slovakia") -> Column:
    """Key of the coordinates' cache."""
    part = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.concat_ws("|", part(street), part(town), F.lit(country.lower()))


def place_query(street: Column, town: Column, country: str = "Slovakia") -> Column:
    """Text to look up; null without street and town."""
    own = F.concat_ws(", ", F.nullif(F.trim(street), F.lit("")), F.nullif(F.trim(town), F.lit("")))
    return F.when(own != "", F.concat_ws(", ", own, F.lit(country)))
