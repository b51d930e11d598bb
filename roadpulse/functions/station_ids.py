"""What a station id tells: road code, km post, direction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse.schemas import STATION_ID


def km_post(station: Column) -> Column:
    """Km post from the four digits; null for an id of another shape."""
    return F.regexp_extract(station, STATION_ID, 1).try_cast("int") / F.lit(10.0)


def road_code(station: Column) -> Column:
    return F.substring(station, 1, 3)


def direction_suffix(station: Column) -> Column:
    """S for an id that ends in S, else N."""
    return F.when(F.right(station, F.lit(1)) == "S", "S").otherwise("N")


def driving_position(km: Column, direction: Column) -> Column:
    """Sort key along the way: northbound km fall, southbound km rise."""
    return F.when(direction == "N", -km).otherwise(km)
