"""Flow queries on detections: series, metrics, breakdown, ranking, trend, detail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import timeparts as tp
from roadpulse.functions.text import first_filled, number_value
from roadpulse.operators import pages
from roadpulse.operators.alias import AliasIndex, attribute
from roadpulse.operators.ranking import numbered_top, percent, share_of
from roadpulse.schemas import DIRECTIONS, UNNAMED_STATION, UNNAMED_VEHICLE

# Column spellings accepted for a detection row.
TIME_NAMES = ["time", "timestamp", "datetime", "date_time", "time_interval", "TimeInterval",
              "DataCollectTime", "start_time", "StartTime"]
STATION_NAMES = ["gantry_id", "gantry", "GantryID", "gantryId", "etc_gantry_id"]
DIRECTION_NAMES = ["direction", "Direction", "dir"]
VEHICLE_NAMES = ["vehicle_type", "vehicleType", "VehicleType", "vehicle", "car_type"]
VOLUME_NAMES = ["traffic_volume", "trafficVolume", "TrafficVolume", "volume", "count",
                "vehicle_count", "flow", "traffic_count"]
STATION_LABELS = ["gantry_name", "gantryName", "GantryName", "location", "road_section"]
DETECTION_MARKS = ["volume", "flow", "trafficvolume", "traffic_volume", "traffic_count",
                   "vehicle_count"]


def selected(detections: DataFrame, span: tp.TimeRange, stations: Sequence[str] | None = None,
             direction: str = "", vehicles: Sequence[int] | None = None,
             alias: DataFrame | AliasIndex | None = None) -> DataFrame:
    """Detections of a closed range; a missing station, direction or vehicle means all."""
    rows = detections.filter(tp.in_minutes("TimeInterval", span))
    if direction in DIRECTIONS:
        rows = rows.filter(F.col("Direction") == direction)
    if vehicles:
        rows = rows.filter(F.col("VehicleType").isin([int(v) for v in vehicles]))
    return attribute(rows, alias, list(stations)) if stations else rows


def series(detections: DataFrame, span: tp.TimeRange, stations: Sequence[str] | None = None,
           direction: str = "", vehicle: int | None = None,
           alias: DataFrame | AliasIndex | None = None) -> DataFrame:
    """Volume per time bucket, station, direction and vehicle at the grain the span asks for."""
    rows = selected(detections, span, stations, direction,
                    None if vehicle is None else [vehicle], alias)
    bucket = tp.flow_bucket(F.col("TimeInterval"), span.span_days, bool(stations))
    return rows.groupBy(
        bucket.alias("time"), F.col("GantryID").alias("gantry_id"),
        F.col("Direction").alias("direction"),
        F.col("VehicleType").cast("string").alias("vehicle_type"),
    ).agg(F.sum("Volume").alias("traffic_volume"))


def page(rows: DataFrame, keys: Sequence[str], limit: int, offset: int = 0) -> DataFrame:
    """One page in key order; the keys must cover all columns for pages not to overlap."""
    return rows.orderBy(*keys).offset(offset).limit(limit)


def detail_rows(detections: DataFrame, span: tp.TimeRange, **filters) -> DataFrame:
    """Detection rows as shown, columns in their order of precedence."""
    return selected(detections, span, **filters).select(
        "TimeInterval", "GantryID", "Direction", "VehicleType", "Volume")


def detail_page(detections: DataFrame, span: tp.TimeRange, limit: int = 1000, offset: int = 0,
                **filters) -> DataFrame:
    """Detection rows in (time, station) order with a full tie-break.

    Fit for the first pages; :func:`detail_pages` gives far ones.
    """
    rows = detail_rows(detections, span, **filters)
    return page(rows, rows.columns, limit, offset)


def detail_pages(detections: DataFrame, span: tp.TimeRange, block: int = pages.BLOCK,
                 **filters) -> pages.Pages:
    """The same rows under an index, for pages at any offset."""
    rows = detail_rows(detections, span, **filters)
    return pages.index(rows, rows.columns, block)


def looks_like_detections(df: DataFrame) -> bool:
    """Whether some column is a vehicle count, by name."""
    names = [name.lower() for name in df.columns]
    return any(name in DETECTION_MARKS or ("traffic" in name and "volume" in name)
               for name in names)


def normalized(df: DataFrame, groups_by_station: DataFrame | None = None) -> DataFrame:
    """Detection rows under common names, whatever spelling the columns came with.

    ``groups_by_station`` (see :func:`operators.stations.group_lookup`) names the
    sections. Rows with nothing in them are left out.
    """
    station = F.trim(first_filled(df, STATION_NAMES))
    given = F.upper(first_filled(df, DIRECTION_NAMES))
    suffix = F.upper(F.right(station, F.lit(1)))
    letter = F.when(given != "", given).otherwise(suffix)
    rows = df.select(
        F.trim(first_filled(df, TIME_NAMES)).alias("time"), station.alias("gantry_id"),
        F.when(letter.isin(DIRECTIONS), letter).otherwise("").alias("direction"),
        F.trim(first_filled(df, VEHICLE_NAMES)).alias("vehicle_type"),
        number_value(first_filled(df, VOLUME_NAMES)).alias("volume"),
        first_filled(df, STATION_LABELS).alias("label"))
    known = F.lit("")
    if groups_by_station is not None:
        names = groups_by_station.select(F.col("station").alias("gantry_id"),
                                         F.col("name").alias("known"))
        rows = rows.join(names, "gantry_id", "left")
        known = F.coalesce("known", F.lit(""))
    name = F.coalesce(F.nullif("label", F.lit("")), F.nullif(known, F.lit("")),
                      F.nullif("gantry_id", F.lit("")), F.lit(UNNAMED_STATION))
    return rows.select("time", "gantry_id", name.alias("gantry_name"), "direction",
                       "vehicle_type", "volume").filter(
        (F.col("time") != "") | (F.col("gantry_id") != "") | (F.col("vehicle_type") != "")
        | (F.col("volume") != 0))


def metrics(rows: DataFrame) -> DataFrame:
    """One row: total, mean per distinct day, stations, peak time and its volume.

    One pass: the facts are combined to (time, station), then to times and to
    stations by grouping sets, and what follows runs on those.
    """
    fine = rows.groupBy("time", "gantry_id").agg(F.sum("traffic_volume").alias("v"))
    both = fine.groupingSets([["time"], ["gantry_id"]], "time", "gantry_id").agg(
        F.sum("v").alias("v"), F.grouping("time").alias("folded"))
    of_time = F.when(F.col("folded") == 0, F.col("v"))
    day = F.nullif(tp.date_part(F.col("time")), F.lit(""))
    summed = both.agg(
        F.sum(of_time).alias("total_volume"), F.countDistinct(day).alias("days"),
        F.count("gantry_id").alias("stations"),
        F.min_by("time", F.when(F.col("folded") == 0, F.struct(-F.col("v"), F.col("time"))))
        .alias("peak_time"), F.max(of_time).alias("peak_volume"))
    return summed.select(
        "total_volume", (F.col("total_volume") / F.greatest("days", F.lit(1))).alias("mean_per_day"),
        "stations", "peak_time", "peak_volume")


def vehicle_breakdown(rows: DataFrame) -> DataFrame:
    """Volume, share and mean per day of each vehicle type, largest first; blank ones are one unnamed type.

    Total and days come from one subquery over the same (vehicle, day) grouping.
    """
    named = F.coalesce(F.nullif(F.trim("vehicle_type"), F.lit("")), F.lit(UNNAMED_VEHICLE))
    fine = rows.groupBy(named.alias("vehicle_type"), tp.date_part(F.col("time")).alias("day")).agg(
        F.sum("traffic_volume").alias("v"))
    per_day = fine.groupBy(F.nullif("day", F.lit("")).alias("day")).agg(F.sum("v").alias("v"))
    whole = per_day.agg(F.sum("v").alias("total"), F.count("day").alias("days")).select(
        F.struct("total", "days")).scalar()
    share = percent(F.col("volume"), whole.getField("total"))
    return fine.groupBy("vehicle_type").agg(F.sum("v").alias("volume")).select(
        "vehicle_type", "volume", share.alias("share"),
        (F.col("volume") / F.greatest(whole.getField("days"), F.lit(1))).alias("mean_per_day")
    ).orderBy(F.desc("volume"), "vehicle_type")


def station_ranking(rows: DataFrame, groups_by_station: DataFrame, top: int = 12) -> DataFrame:
    """Top sections by volume; a station without a section ranks as itself per direction."""
    per_station = rows.groupBy("gantry_id", "direction").agg(
        F.sum("traffic_volume").alias("volume"))
    looked_up = groups_by_station.select(
        F.col("station").alias("gantry_id"), F.col("group_id").alias("section"), "name",
        F.col("group_direction"), "current_gantry_id")
    joined = per_station.join(looked_up, "gantry_id", "left")
    ranked = joined.groupBy(
        F.coalesce("section", F.concat_ws("|||", "gantry_id", "direction")).alias("key"),
        F.coalesce("current_gantry_id", "gantry_id").alias("gantry_id"),
        F.coalesce("name", "gantry_id").alias("name"),
        F.coalesce("group_direction", "direction").alias("direction"),
    ).agg(F.sum("volume").alias("volume"))
    return numbered_top(share_of(ranked, "volume"), [F.desc("volume"), F.asc("key")], top)


def trend(rows: DataFrame, span: tp.TimeRange) -> DataFrame:
    """Volume per trend bucket of the span, in time order."""
    return rows.groupBy(
        tp.trend_bucket(F.col("time"), span.span_days).alias("bucket")).agg(
        F.sum("traffic_volume").alias("volume")).orderBy("bucket")


def any_of(values: Sequence[str] | str | None) -> list[str] | None:
    """A list given as text with commas or as a list; blank or ``all`` means no filter."""
    if isinstance(values, str):
        values = [] if values.strip().lower() == "all" else values.split(",")
    kept = [str(value).strip() for value in values or [] if str(value).strip()]
    return kept or None
