"""Road sections: normalising, lookup, driving order, validity, OD candidates, corridors."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.functions.station_ids import (direction_suffix, driving_position, km_post,
                                             road_code)
from roadpulse.functions.text import first_filled
from roadpulse.schemas import OTHER_ROADS, UNNAMED_SECTION, road_direction_label

# Coordinate spellings.
LAT_NAMES = ["lat", "latitude", "Latitude", "y"]
LNG_NAMES = ["lng", "lon", "longitude", "Longitude", "x"]


def coordinate(df: DataFrame, names: list[str]) -> Column:
    """First coordinate spelling that is present, null unless finite."""
    present = [F.col(name).cast("string") for name in names if name in df.columns]
    value = F.coalesce(*present, F.lit(None).cast("string")).try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def version_of(names: Sequence[str], field: Callable[[str], Column]) -> Column:
    """A validity version out of those of its fields that are there."""
    return F.struct(*[
        (field(c) if c in names else F.lit(None)).cast(t).alias(c)
        for c, t in (("first_seen", "string"), ("last_seen", "string"), ("is_active", "boolean"))])


def listed_versions(raw: DataFrame) -> Column:
    """The ``versions`` column under one struct type; null where there is none."""
    element = (getattr(raw.schema["versions"].dataType, "elementType", None)
               if "versions" in raw.columns else None)
    if not isinstance(element, T.StructType):
        return F.lit(None).cast(
            "array<struct<first_seen:string,last_seen:string,is_active:boolean>>")
    return F.transform("versions", lambda v: version_of(element.names, v.getField))


def normalize_groups(raw: DataFrame) -> DataFrame:
    """Section records with every fallback applied: ids, name, direction, label, road."""
    current = first_filled(raw, ["current_gantry_id", "gantry_id"])
    listed = (F.col("gantry_ids") if "gantry_ids" in raw.columns
              else F.lit(None).cast("array<string>"))
    ids = F.when(F.size(listed) > 0, listed).when(current != "", F.array(current)).otherwise(
        F.array().cast("array<string>"))
    name = F.coalesce(F.nullif(first_filled(raw, ["display_name", "name", "gantry_name"]),
                               F.lit("")),
                      F.nullif(current, F.lit("")), F.lit(UNNAMED_SECTION))
    given = first_filled(raw, ["direction"])
    direction = F.when(given != "", F.when(given == "S", "S").otherwise("N")).otherwise(
        direction_suffix(current))
    label = first_filled(raw, ["direction_label"])
    versions = listed_versions(raw)
    own = version_of(raw.columns, F.col)
    road = first_filled(raw, ["road", "road_name", "road_label"])
    group = first_filled(raw, ["group_id"])
    return raw.select(
        F.when(group != "", group).otherwise(F.concat(F.lit("G_"), current)).alias("group_id"),
        current.alias("current_gantry_id"), ids.alias("gantry_ids"), name.alias("name"),
        direction.alias("group_direction"),
        F.when(label != "", label).otherwise(road_direction_label(direction))
        .alias("direction_label"),
        F.trim(road).alias("road"),
        km_post(F.coalesce(F.nullif(current, F.lit("")), F.try_element_at(ids, F.lit(1))))
        .alias("km"),
        coordinate(raw, LAT_NAMES).alias("lat"), coordinate(raw, LNG_NAMES).alias("lng"),
        F.when(F.size(versions) > 0, versions).otherwise(F.array(own)).alias("versions"))


def group_lookup(groups: DataFrame) -> DataFrame:
    """One section per station id; of several, the smallest ``group_id`` wins."""
    ids = F.array_distinct(F.concat(F.array("current_gantry_id"), F.col("gantry_ids")))
    section = F.struct("group_id", "current_gantry_id", "name", "group_direction",
                       "direction_label", "lat", "lng")
    return (groups.select(F.explode(ids).alias("station"), section.alias("section"))
            .filter(F.col("station") != "")
            .groupBy("station").agg(F.min_by("section", F.col("section")["group_id"])
                                    .alias("section"))
            .select("station", "section.*"))


def with_aliases(lookup: DataFrame, alias: DataFrame) -> DataFrame:
    """The lookup with the ids that reach a section only through their canonical id."""
    through = alias.select(F.col("id").alias("alias_id"), F.col("canonical").alias("station")).join(
        lookup, "station").drop("station").withColumnRenamed("alias_id", "station")
    return lookup.unionByName(through.join(lookup, "station", "left_anti"))


def road_name(groups: DataFrame) -> Column:
    return F.coalesce(F.nullif(F.trim("road"), F.lit("")), F.lit(OTHER_ROADS))


def roads(groups: DataFrame) -> DataFrame:
    """Distinct roads in order, blank ones under one name."""
    return groups.select(road_name(groups).alias("road")).distinct().orderBy("road")


def valid_between(versions: Column, first: date, last: date) -> Column:
    """Some version overlaps the days: begun by the last one and, if closed, not over before.

    A version in use has no end; a closed one without dates is never valid.
    """
    low, high = F.lit(first.isoformat()), F.lit(last.isoformat())

    def overlaps(version: Column) -> Column:
        active = F.coalesce(version["is_active"], F.lit(False))
        begin = F.nullif(version["first_seen"].cast("string"), F.lit(""))
        end = F.nullif(version["last_seen"].cast("string"), F.lit(""))
        dated = active | begin.isNotNull() | end.isNotNull()
        return (dated & F.coalesce(begin <= high, F.lit(True))
                & (active | F.coalesce(end >= low, F.lit(True))))

    return F.exists(versions, overlaps)


#: Begin and end of versions that have none.
FIRST_DAY, LAST_DAY = "0001-01-01", "9999-12-31"


def section_spans(groups: DataFrame) -> DataFrame:
    """Which section a station belongs to on which days: (station, begin, end, section fields).

    The days of a version are those of :func:`valid_between`: from its first day, if it has one,
    to its last, or for ever while in use; a version without days and not in use has none, nor
    has a section without versions. Where versions of several sections overlap the smallest
    ``group_id`` wins, as in :func:`group_lookup`. The spans of a station are disjoint, in whole
    days as text, both ends included.
    """
    ids = F.array_distinct(F.concat(F.array("current_gantry_id"), F.col("gantry_ids")))
    section = F.struct("group_id", "current_gantry_id", "name", "group_direction",
                       "direction_label", "lat", "lng")
    active = F.coalesce(F.col("version.is_active"), F.lit(False))
    seen, left = (F.nullif(F.substring(f"version.{c}", 1, 10), F.lit("")).try_cast("date")
                  for c in ("first_seen", "last_seen"))
    open_end, open_begin = F.lit(LAST_DAY).cast("date"), F.lit(FIRST_DAY).cast("date")
    held = (groups.select(F.explode(ids).alias("station"), section.alias("section"), "versions")
            .filter(F.col("station") != "")
            .select("station", "section", F.explode("versions").alias("version"))
            .filter(active | seen.isNotNull() | left.isNotNull())
            .select("station", "section", F.coalesce(seen, open_begin).alias("begin"),
                    F.when(active, open_end).otherwise(F.coalesce(left, open_end)).alias("end"))
            .filter(F.col("begin") <= F.col("end")))
    # A station's days are cut wherever one of its versions begins or is over.
    after = F.when(F.col("end") < open_end, F.date_add("end", 1))
    cuts = held.select("station", F.explode(F.array("begin", after)).alias("from")).filter(
        F.col("from").isNotNull()).distinct()
    following = F.lead("from").over(Window.partitionBy("station").orderBy("from"))
    pieces = cuts.select("station", "from", F.coalesce(F.date_sub(following, 1), open_end).alias("to"))
    inside = held.join(pieces, "station").filter(F.col("from").between(F.col("begin"), F.col("end")))
    chosen = inside.groupBy("station", "from", "to").agg(
        F.min_by("section", F.col("section.group_id")).alias("section"))
    # Neighbouring pieces of one section are one span.
    order = Window.partitionBy("station").orderBy("from")
    same = (F.lag("section.group_id").over(order) == F.col("section.group_id")) \
        & (F.lag("to").over(order) == F.date_sub("from", 1))
    run = F.sum(F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).over(order)
    return chosen.withColumn("run", run).groupBy("station", "run").agg(
        F.min("from").cast("string").alias("begin"), F.max("to").cast("string").alias("end"),
        F.first("section").alias("section")).select("station", "begin", "end", "section.*")


def in_section(rows: DataFrame, spans: DataFrame, station: str = "GantryID", day: str = "day") -> DataFrame:
    """Rows with the section their station was in on their day (``yyyy-MM-dd``), null in none.

    Spans of a station are disjoint, so no row is doubled. Sum rows by station and day before.
    """
    one = spans.select(F.col("station").alias("__station"), F.col("begin").alias("__begin"),
                       F.col("end").alias("__end"), F.struct(*[
                           c for c in spans.columns if c not in ("station", "begin", "end")])
                       .alias("section"))
    found = (F.col(station) == F.col("__station")) & F.col(day).between(
        F.col("__begin"), F.col("__end"))
    return rows.join(one, found, "left").drop("__station", "__begin", "__end")


def driving_order(groups: DataFrame) -> DataFrame:
    """Place of each section on its road and direction: by km along the way, then by name.

    The dimension has one row per section, so a road's window stays small.
    """
    along = Window.partitionBy("road", "group_direction").orderBy(
        F.asc_nulls_last(driving_position(F.col("km"), F.col("group_direction"))),
        "name", "group_id")
    return groups.withColumn("road", road_name(groups)).withColumn(
        "place", F.row_number().over(along))


def active_sections(groups: DataFrame, first: date, last: date, road: str | None = None,
                    direction: str | None = None) -> DataFrame:
    """Sections valid in a range of days, optionally of one road and direction."""
    kept = groups.filter(valid_between(F.col("versions"), first, last))
    if road is not None:
        kept = kept.filter(road_name(groups) == road)
    if direction:
        kept = kept.filter(F.col("group_direction") == direction)
    return driving_order(kept)


def candidates(groups: DataFrame, starts: DataFrame,
               days: tuple[date, date] | None = None) -> DataFrame:
    """End sections offered for requested starts (``start_id``).

    On the start's road those further along, on other roads all of the same
    direction, tagged as a change of road. With ``days`` only sections valid in them are
    starts or ends.
    """
    ordered = driving_order(groups) if days is None else active_sections(groups, *days)
    start = ordered.join(starts, F.col("group_id") == F.col("start_id")).select(
        "start_id", "group_direction", F.col("road").alias("start_road"),
        F.col("place").alias("start_place"))
    same = F.col("road") == F.col("start_road")
    return (ordered.join(start, "group_direction")
            .filter(~same | (F.col("place") > F.col("start_place")))
            .select("start_id", F.col("group_id").alias("end_id"), "road", "place",
                    (~same).alias("other_road")))


def corridor(groups: DataFrame, pairs: DataFrame) -> DataFrame:
    """Sections between the ends of requested pairs (``start_id``, ``end_id``), with their step.

    Both ends on one road; the direction is the start's; coordinates and km known.
    """
    place = groups.filter(F.trim("road") != "").select(
        "group_id", "group_direction", "road", "km").filter(F.col("km").isNotNull())
    start = place.select(F.col("group_id").alias("start_id"), "group_direction", "road",
                         F.col("km").alias("start_km"))
    end = place.select(F.col("group_id").alias("end_id"), F.col("road").alias("end_road"),
                       F.col("km").alias("end_km"))
    asked = (pairs.select("start_id", "end_id").distinct().join(start, "start_id")
             .join(end, "end_id").filter(F.col("road") == F.col("end_road")))
    inside = groups.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull()
                           & F.col("km").isNotNull())
    matched = asked.join(inside, ["road", "group_direction"]).filter(F.col("km").between(
        F.least("start_km", "end_km"), F.greatest("start_km", "end_km")))
    step = F.row_number().over(Window.partitionBy("start_id", "end_id").orderBy(
        driving_position(F.col("km"), F.col("group_direction")), "group_id"))
    return matched.select("start_id", "end_id", step.alias("step"), "group_id", "km", "lat", "lng")


def co_located(groups: DataFrame) -> DataFrame:
    """Sections that share a place at five decimals, northbound first, with their position."""
    spot = groups.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull()).withColumn(
        "spot", F.concat_ws(",", F.format_string("%.5f", "lat"), F.format_string("%.5f", "lng")))
    here = Window.partitionBy("spot")
    return spot.select(
        "spot", "group_id", "group_direction",
        F.row_number().over(here.orderBy("group_direction", "group_id")).alias("position"),
        F.count(F.lit(1)).over(here).alias("size"))


def pair_validity(pairs: DataFrame) -> DataFrame:
    """Why an OD request (``start_gantry``, ``end_gantry``, their group ids) is refused, or ``ok``."""
    start, end = F.col("start_gantry"), F.col("end_gantry")
    km_a, km_b = km_post(start), km_post(end)
    northbound = F.right(start, F.lit(1)) == "N"
    backwards = F.when(northbound, km_a <= km_b).otherwise(km_a >= km_b)
    return pairs.withColumn("verdict", (
        F.when((start == "") | (end == ""), "missing")
        .when((F.col("start_group") != "") & (F.col("start_group") == F.col("end_group")),
              "same section")
        .when(F.right(start, F.lit(1)) != F.right(end, F.lit(1)), "opposite direction")
        .when((road_code(start) == road_code(end)) & F.coalesce(backwards, F.lit(False)),
              "against the way")
        .otherwise("ok")))


def oriented(groups: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs of sections (``first_id``, ``second_id``) put in driving direction.

    Opposite directions make no pair; on one road an end upstream of the start
    swaps the two.
    """
    ordered = driving_order(groups)
    a = ordered.select(F.col("group_id").alias("first_id"), F.col("group_direction").alias("da"),
                       F.col("road").alias("ra"), F.col("place").alias("pa"))
    b = ordered.select(F.col("group_id").alias("second_id"), F.col("group_direction").alias("db"),
                       F.col("road").alias("rb"), F.col("place").alias("pb"))
    joined = pairs.join(a, "first_id").join(b, "second_id")
    swap = (F.col("ra") == F.col("rb")) & (F.col("pb") < F.col("pa"))
    state = (F.when(F.col("first_id") == F.col("second_id"), "same")
             .when(F.col("da") != F.col("db"), "opposite")
             .when(swap, "swapped").otherwise("kept"))
    turned = state == "swapped"
    return joined.select(
        "first_id", "second_id", state.alias("state"),
        F.when(turned, F.col("second_id")).otherwise(F.col("first_id")).alias("start_id"),
        F.when(turned, F.col("first_id")).otherwise(F.col("second_id")).alias("end_id"))
