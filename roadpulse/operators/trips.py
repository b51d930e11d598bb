"""OD queries on trips: detail, travel time, trend, pivot, metrics, modal route."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import paths
from roadpulse.functions import timeparts as tp
from roadpulse.functions.text import first_filled, first_minutes, number_value
from roadpulse.operators import pages
from roadpulse.operators.flow import page
from roadpulse.operators.ranking import peak_of
from roadpulse.schemas import VEHICLE_ORDER

# Column spellings accepted for a trip row.
ORIGIN_TIME_NAMES = ["origin_time", "start_time", "entry_time", "time_o", "Time_O",
                     "DetectionTime_O", "detection_time_o", "trip_start_time", "timestamp", "time"]
END_TIME_NAMES = ["destination_time", "end_time", "exit_time", "time_d", "Time_D",
                  "DetectionTime_D", "detection_time_d", "trip_end_time"]
START_NAMES = ["start_gantry", "gantry_o", "GantryID_O", "origin_gantry", "gantry_from",
               "start_gantry_id"]
END_NAMES = ["end_gantry", "gantry_d", "GantryID_D", "destination_gantry", "gantry_to",
             "end_gantry_id"]
TRIP_VEHICLE_NAMES = ["vehicle_type", "vehicleType", "VehicleType", "car_type", "vehicle"]
COUNT_NAMES = ["trip_count", "tripCount", "count", "vehicle_count", "total_trips", "volume"]
MINUTE_NAMES = ["avg_travel_time_minutes", "travel_time_minutes", "travel_time",
                "trip_time_minutes", "duration_minutes", "avg_duration_minutes"]
SECOND_NAMES = ["travel_time_seconds", "trip_time_seconds", "duration_seconds"]
TRIP_MARKS = ["trip", "gantry_o", "gantry_d", "origin", "destination", "detectiontime_o",
              "detectiontime_d"]
TRIP_ENDS = ["start_gantry", "end_gantry"]


def passing(trips: DataFrame, starts: Sequence[str], ends: Sequence[str]) -> DataFrame:
    """Trips that pass some start before some end: cheap prefilter first, then the order."""
    path = F.col("TripInformation")
    return (trips.filter(paths.contains_any(path, starts) & paths.contains_any(path, ends))
            .filter(paths.passes_in_order(path, starts, ends)))


def of_vehicles(trips: DataFrame, vehicles: Sequence[int] | None) -> DataFrame:
    if not vehicles:
        return trips
    return trips.filter(F.col("VehicleType").isin([int(v) for v in vehicles]))


def detail_rows(trips: DataFrame, span: tp.TimeRange, starts: Sequence[str], ends: Sequence[str],
                vehicles: Sequence[int] | None = None) -> DataFrame:
    """Trips of a range that pass start before end, under their public names, departure first."""
    rows = of_vehicles(passing(trips.filter(tp.in_seconds("DetectionTime_O", span)),
                               starts, ends), vehicles)
    return rows.select(
        F.col("DetectionTime_O").alias("DetectionTimeO"), "VehicleType",
        F.col("GantryID_O").alias("GantryO"), F.col("DetectionTime_D").alias("DetectionTimeD"),
        F.col("GantryID_D").alias("GantryD"), "TripLength", "TripEnd", "TripInformation")


def detail_page(trips: DataFrame, span: tp.TimeRange, starts: Sequence[str], ends: Sequence[str],
                vehicles: Sequence[int] | None = None, limit: int = 1000,
                offset: int = 0) -> DataFrame:
    """Trips by departure time that pass start before end, under their public names.

    Fit for the first pages; :func:`detail_pages` gives far ones.
    """
    rows = detail_rows(trips, span, starts, ends, vehicles)
    shown = ["VehicleType", *(c for c in rows.columns if c != "VehicleType")]
    return page(rows, rows.columns, limit, offset).select(*shown)


def detail_pages(trips: DataFrame, span: tp.TimeRange, starts: Sequence[str], ends: Sequence[str],
                 vehicles: Sequence[int] | None = None, block: int = pages.BLOCK) -> pages.Pages:
    """The same rows under an index, for pages at any offset."""
    rows = detail_rows(trips, span, starts, ends, vehicles)
    return pages.index(rows, rows.columns, block)


def stretches(trips: DataFrame, span: tp.TimeRange, starts: Sequence[str], ends: Sequence[str],
              vehicle: int | None = None) -> DataFrame:
    """Trips with their passing times at the first start and the last end after it.

    A trip departs before it passes the start, so the pushed-down range on the
    departure is one day wider; the exact range is on the time at the start.
    """
    path = F.col("TripInformation")
    coarse = tp.in_seconds("DetectionTime_O", span.padded(before=1))
    rows = of_vehicles(trips.filter(coarse), None if vehicle is None else [vehicle])
    rows = rows.filter(paths.contains_any(path, starts) & paths.contains_any(path, ends))
    time_a, time_b = paths.stretch_times(F.col("stretch"))
    once = paths.computed_once(paths.stretch(path, starts, ends))
    return (rows.select("*", once.alias("stretch"))
            .filter(F.col("stretch") != "")
            .withColumns({"time_a": time_a, "time_b": time_b}).drop("stretch")
            .filter(tp.in_seconds("time_a", span)))


def travel_time(matched: DataFrame) -> DataFrame:
    """Trips and mean minutes per 15 minutes at the start and vehicle.

    Keeps the seconds, so means over wider groups need no rounded value.
    """
    seconds = tp.wall_seconds(F.col("time_b")) - tp.wall_seconds(F.col("time_a"))
    grouped = matched.groupBy(
        tp.slot_of(F.col("time_a"), 15).alias("origin_time"),
        F.col("VehicleType").cast("string").alias("vehicle_type"),
    ).agg(F.count(F.lit(1)).alias("trip_count"), F.sum(seconds).alias("sum_seconds"))
    return grouped.withColumn("avg_travel_time_minutes", F.round(
        F.col("sum_seconds") / (F.col("trip_count") * 60.0), 1))


def totals_by_time(rows: DataFrame, span: tp.TimeRange) -> DataFrame:
    """Trips per trend bucket of the span and vehicle."""
    return rows.groupBy(tp.trip_bucket(F.col("origin_time"), span.span_days).alias("bucket"),
                        "vehicle_type").agg(F.sum("trip_count").alias("trip_count"))


def totals_by_vehicle(rows: DataFrame) -> DataFrame:
    return rows.groupBy("vehicle_type").agg(F.sum("trip_count").alias("trip_count"))


def pivot(rows: DataFrame, span: tp.TimeRange) -> DataFrame:
    """Trips per bucket with one column per vehicle in domain order, and the row total, by time."""
    count = F.col("trip_count")
    columns = [F.coalesce(F.sum(F.when(F.col("vehicle_type") == str(code), count)), F.lit(0))
               .alias(f"v{code}") for code in VEHICLE_ORDER]
    return rows.groupBy(
        tp.trip_bucket(F.col("origin_time"), span.span_days).alias("bucket")
    ).agg(*columns, F.sum(count).alias("total")).orderBy("bucket")


def mean_travel_minutes(rows: DataFrame) -> DataFrame:
    """Mean minutes over all trips, from the seconds; null without trips."""
    return rows.agg((F.sum("sum_seconds") / (F.sum("trip_count") * 60.0)).alias("mean_minutes"),
                    F.coalesce(F.sum("trip_count"), F.lit(0)).alias("trips"))


def weighted_mean(rows: DataFrame, minutes: str = "travel_minutes",
                  weight: str = "trip_count") -> DataFrame:
    """Mean of given minutes weighted by trips; unusable and negative ones are left out."""
    usable = rows.filter((F.col(minutes) >= 0) & (F.col(minutes) < float("inf")))
    return usable.agg((F.sum(F.col(minutes) * F.col(weight)) / F.sum(weight))
                      .alias("mean_minutes"))


def metrics(rows: DataFrame, span: tp.TimeRange) -> DataFrame:
    """One row: trips, mean per hour, peak bucket, main vehicle and its share."""
    fine = totals_by_time(rows, span)
    peak = peak_of(fine.groupBy("bucket").agg(F.sum("trip_count").alias("n")), "bucket", "n")
    top = peak.select(F.struct("bucket", "n")).scalar()
    vehicles = totals_by_vehicle(rows).agg(
        F.sum("trip_count").alias("trips"),
        F.min_by("vehicle_type", F.struct(-F.col("trip_count"), F.col("vehicle_type")))
        .alias("main_vehicle"),
        F.max("trip_count").alias("main_trips"))
    return vehicles.select(
        "trips", (F.col("trips") / span.span_hours).alias("mean_per_hour"),
        top.getField("bucket").alias("peak_time"), top.getField("n").alias("peak_trips"),
        "main_vehicle", "main_trips",
        F.round(F.col("main_trips") / F.col("trips") * 100, 1).alias("main_share"))


def route_counts(trips: DataFrame, starts: Sequence[str], ends: Sequence[str]) -> DataFrame:
    """How often each station sequence from start to end was driven."""
    path = F.col("TripInformation")
    near = trips.filter(paths.contains_any(path, starts) & paths.contains_any(path, ends))
    route = paths.route_between(paths.station_ids(path), starts, ends)
    return (near.select(paths.computed_once(F.array_join(route, ",")).alias("route"))
            .filter(F.col("route").isNotNull())
            .groupBy("route").agg(F.count(F.lit(1)).alias("trips")))


def modal_route(trips: DataFrame, starts: Sequence[str], ends: Sequence[str]) -> DataFrame:
    """The most driven station sequence over all matching trips, smallest on ties."""
    return route_counts(trips, starts, ends).orderBy(F.desc("trips"), "route").limit(1)


def answer(matched: DataFrame, starts: Sequence[str], ends: Sequence[str]) -> DataFrame:
    """Rows and modal route of an OD request in one table, out of one pass over the paths.

    ``part`` is ``time`` for the rows of :func:`travel_time` and ``route`` for the one most driven
    station sequence, with its trips and mean minutes. Trips are grouped once by slot, vehicle
    and route; both parts add that up, and its exchange is read twice.
    """
    route = F.array_join(paths.route_between(paths.station_ids(F.col("TripInformation")), starts, ends), ",")
    seconds = tp.wall_seconds(F.col("time_b")) - tp.wall_seconds(F.col("time_a"))
    fine = matched.select(
        tp.slot_of(F.col("time_a"), 15).alias("origin_time"),
        F.col("VehicleType").cast("string").alias("vehicle_type"), seconds.alias("seconds"),
        paths.computed_once(route).alias("route"),
    ).groupBy("origin_time", "vehicle_type", "route").agg(
        F.count(F.lit(1)).alias("n"), F.sum("seconds").alias("seconds"))
    both = [F.sum("n").alias("trip_count"), F.sum("seconds").alias("sum_seconds")]
    times = fine.groupBy("origin_time", "vehicle_type").agg(*both)
    # No filter on the route: pushed below the grouping it would make another one of it.
    order = F.struct(F.col("route").isNull(), -F.col("trip_count"), F.col("route"))
    top = fine.groupBy("route").agg(*both).agg(
        F.min_by(F.struct("route", "trip_count", "sum_seconds"), order).alias("top")
    ).select("top.*").filter(F.col("route").isNotNull())
    none = F.lit(None).cast("string")
    united = times.select(F.lit("time").alias("part"), "origin_time", "vehicle_type", "trip_count",
                          "sum_seconds", none.alias("route")).unionByName(
        top.select(F.lit("route").alias("part"), none.alias("origin_time"),
                   none.alias("vehicle_type"), "trip_count", "sum_seconds", "route"))
    return united.withColumn("avg_travel_time_minutes", F.round(
        F.col("sum_seconds") / (F.col("trip_count") * 60.0), 1)).drop("sum_seconds").orderBy(
        F.desc("part"), "origin_time", "vehicle_type")


def trip_legs(trips: DataFrame) -> DataFrame:
    """One row per passed station: position, time, station."""
    kept = [c for c in trips.columns if c != "TripInformation"]
    return trips.select(*kept, F.posexplode(paths.legs(F.col("TripInformation")))).select(
        *kept, (F.col("pos") + 1).alias("position"), F.col("col.time").alias("time"),
        F.col("col.station").alias("station"))


def looks_like_trips(df: DataFrame) -> bool:
    """Whether some column belongs to a trip, by name."""
    names = [name.lower() for name in df.columns]
    return any(name in TRIP_ENDS or any(mark in name for mark in TRIP_MARKS) for name in names)


def normalized(df: DataFrame, start: str = "", end: str = "", vehicle: str = "") -> DataFrame:
    """Trip rows under common names, whatever spelling the columns came with.

    The request's start, end and vehicle fill blanks. Travel minutes come from
    minutes, else seconds, else the two times. Rows without trips are left out.
    """
    def or_asked(names: Sequence[str], asked: str) -> Column:
        value = first_filled(df, names)
        return F.trim(F.when(value != "", value).otherwise(asked))

    origin = F.trim(first_filled(df, ORIGIN_TIME_NAMES))
    until = F.trim(first_filled(df, END_TIME_NAMES))
    count, seconds = first_filled(df, COUNT_NAMES), first_filled(df, SECOND_NAMES)
    between = tp.minutes_between(origin, until)
    return df.select(
        origin.alias("origin_time"), until.alias("destination_time"),
        or_asked(START_NAMES, start).alias("start_gantry"),
        or_asked(END_NAMES, end).alias("end_gantry"),
        or_asked(TRIP_VEHICLE_NAMES, vehicle).alias("vehicle_type"),
        F.when(count == "", 1.0).otherwise(F.greatest(number_value(count), F.lit(0.0)))
        .alias("trip_count"),
        F.coalesce(first_minutes(df, MINUTE_NAMES),
                   F.when(seconds != "", number_value(seconds) / 60),
                   F.when(between >= 0, between)).alias("travel_minutes"),
    ).filter("trip_count > 0")
