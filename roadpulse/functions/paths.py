"""Trip paths: text ``<time>+<station>; <time>+<station>; ...`` in passing order."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the time pattern inside a path.
LEG_TIME = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"


def computed_once(value: Column) -> Column:
    """The value as the single element of an exploded array.

    Filters on what comes out are not pushed below the generator, so an
    expensive expression is not repeated in each of them.
    """
    return F.explode(F.array(value))


def one_of(ids: Sequence[str]) -> str:
    return "|".join(re.escape(station) for station in ids)


def contains_any(path: Column, ids: Sequence[str]) -> Column:
    """Cheap prefilter; ``contains`` reaches the Parquet scan, ``instr`` does not."""
    return reduce(lambda left, right: left | right, [path.contains(station) for station in ids])


def passes_in_order(path: Column, starts: Sequence[str], ends: Sequence[str]) -> Column:
    """Some start station comes before some end station."""
    return path.rlike(f"({one_of(starts)}).*({one_of(ends)})")


def stretch(path: Column, starts: Sequence[str], ends: Sequence[str]) -> Column:
    """Path text from the first start station to the last end station, blank if none.

    One regular expression run gives both times, see :func:`stretch_times`. Pass it
    through :func:`computed_once` if filters on it follow.
    """
    pattern = rf"{LEG_TIME}\+(?:{one_of(starts)}).*{LEG_TIME}\+(?:{one_of(ends)})"
    return F.regexp_extract(path, pattern, 0)


def stretch_times(matched: Column) -> tuple[Column, Column]:
    """Passing times at the two ends of a matched stretch."""
    last_leg = F.substring_index(matched, ";", -1)
    return F.substring(matched, 1, 19), F.regexp_extract(last_leg, LEG_TIME, 0)


def station_ids(path: Column) -> Column:
    """Station ids in passing order."""
    return F.transform(F.split(path, ";"), lambda leg: F.trim(F.substring_index(leg, "+", -1)))


def legs(path: Column) -> Column:
    """Array of ``(time, station)``."""
    return F.transform(F.split(path, ";"), lambda leg: F.struct(
        F.trim(F.substring_index(leg, "+", 1)).alias("time"),
        F.trim(F.substring_index(leg, "+", -1)).alias("station")))


def route_between(ids: Column, starts: Sequence[str], ends: Sequence[str]) -> Column:
    """Ids from the first start to the last end after it; null without such a stretch."""
    first = F.array_position(F.transform(ids, lambda s: s.isin(list(starts))), True)
    from_back = F.array_position(F.reverse(F.transform(ids, lambda s: s.isin(list(ends)))), True)
    last = F.size(ids) + 1 - from_back
    return F.when((first > 0) & (from_back > 0) & (last > first),
                  F.slice(ids, first.cast("int"), (last - first + 1).cast("int")))


def without_repeats(points: Column) -> Column:
    """Drop elements equal to the one before them."""
    return F.filter(points, lambda point, i: (i == 0) | ~point.eqNullSafe(
        F.try_element_at(points, F.greatest(i, F.lit(1)))))
