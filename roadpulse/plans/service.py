"""Requests as dictionaries in, DataFrames out: what a query page or dashboard asks for."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.timeparts import TimeRange, parse_day, period_label
from roadpulse.operators import flow, quality, stats, trips
from roadpulse.operators.alias import AliasIndex, expanded_ids
from roadpulse.operators.pages import Pages
from roadpulse.sources import lake, snapshots


@dataclass
class TrafficData:
    """The two lake roots and the station dimensions a request needs."""

    spark: SparkSession
    detections_root: str
    trips_root: str
    alias: DataFrame | None = None
    sections: DataFrame | None = None

    #: Detections kept partly by day: both layouts are read.
    days_too: bool = False

    @cached_property
    def aliases(self) -> AliasIndex | None:
        """The alias table, fetched with the first request that names a station."""
        return None if self.alias is None else AliasIndex(self.alias)

    def detections(self, span: TimeRange) -> DataFrame:
        if self.days_too:
            return lake.mixed_layout(self.spark, self.detections_root, "M03A", span)
        return lake.scan(self.spark, self.detections_root, "M03A", span)

    def trips(self, span: TimeRange) -> DataFrame:
        return lake.scan(self.spark, self.trips_root, "M06A", span)

    def known_sections(self) -> DataFrame:
        """The section lookup; without one it is empty and stations stand for themselves."""
        if self.sections is not None:
            return self.sections
        return self.spark.createDataFrame([], "station string, group_id string")

    def coverage(self, dtype: str) -> DataFrame:
        """First and last day of a fact by its months, no data read."""
        root = self.detections_root if dtype == "M03A" else self.trips_root
        months = [e[:2] for e in snapshots.entries(self.spark, root) if e.rows != 0]
        return quality.coverage(self.spark.createDataFrame(months, "year string, month string"))


@dataclass
class Answer:
    """All rows of a query in their order, and the modal route of an OD query; callers limit what
    they show."""

    rows: DataFrame
    route: DataFrame | None = None


def asked_range(payload: dict, max_days: int | None = None) -> TimeRange:
    return TimeRange.of(payload["start_time"], payload["end_time"]).check(max_days)


def asked_vehicle(payload: dict) -> int | None:
    text = str(payload.get("vehicle_type") or "").strip()
    return int(text) if text else None


def query(data: TrafficData, payload: dict, max_days: int | None = None) -> Answer:
    """A flow (``M03A``) or OD (``M06A``) request; ``max_days`` refuses longer spans."""
    dataset = payload.get("dataset")
    if dataset == "M03A":
        return Answer(flow_query(data, payload, max_days))
    if dataset == "M06A":
        return od_query(data, payload, max_days)
    raise ValueError("dataset must be M03A or M06A")


def flow_query(data: TrafficData, payload: dict, max_days: int | None = None) -> DataFrame:
    span = asked_range(payload, max_days)
    return flow.series(
        data.detections(span), span, flow.any_of(payload.get("gantry_ids")),
        str(payload.get("direction") or "").strip().upper(), asked_vehicle(payload), data.aliases
    ).orderBy("time", "gantry_id", "direction", "vehicle_type")


def asked_ends(data: TrafficData, payload: dict) -> tuple[list[str], list[str], str, str]:
    starts = (flow.any_of(payload.get("start_gantry_ids"))
              or flow.any_of(payload.get("start_gantry")))
    ends = flow.any_of(payload.get("end_gantry_ids")) or flow.any_of(payload.get("end_gantry"))
    if not starts or not ends:
        raise ValueError("an OD request needs start and end stations")
    starts, ends = expanded_ids(data.aliases, starts, ends)
    return (starts, ends, str(payload.get("start_gantry") or starts[0]),
            str(payload.get("end_gantry") or ends[0]))


def od_query(data: TrafficData, payload: dict, max_days: int | None = None) -> Answer:
    span = asked_range(payload, max_days)
    starts, ends, start_name, end_name = asked_ends(data, payload)
    found = data.trips(span)
    matched = trips.stretches(found, span, starts, ends, asked_vehicle(payload))
    rows = trips.travel_time(matched).select(
        "origin_time", "vehicle_type", "trip_count", "avg_travel_time_minutes",
        F.lit(start_name).alias("start_gantry"), F.lit(end_name).alias("end_gantry")
    ).orderBy("origin_time", "vehicle_type")
    return Answer(rows, trips.modal_route(matched, starts, ends))


def od_answer(data: TrafficData, payload: dict, max_days: int | None = None) -> DataFrame:
    """Rows and modal route of an OD request as one table from one scan, see :func:`trips.answer`."""
    span = asked_range(payload, max_days)
    starts, ends, start_name, end_name = asked_ends(data, payload)
    matched = trips.stretches(data.trips(span), span, starts, ends, asked_vehicle(payload))
    return trips.answer(matched, starts, ends).select(
        "*", F.lit(start_name).alias("start_gantry"), F.lit(end_name).alias("end_gantry"))


def detections_page(data: TrafficData, start: str, end: str, gantry: str = "all",
                    vehicle_type: str = "all", limit: int = 1000, offset: int = 0) -> DataFrame:
    """Detection rows page by page."""
    span = TimeRange.of(start, end)
    vehicles = flow.any_of(vehicle_type)
    return flow.detail_page(
        data.detections(span), span, limit=limit, offset=offset,
        stations=flow.any_of(gantry), alias=data.aliases,
        vehicles=[int(v) for v in vehicles] if vehicles else None)


def trips_page(data: TrafficData, start: str, end: str, gantry_o: str, gantry_d: str,
               vehicle_type: str = "all", limit: int = 1000, offset: int = 0) -> DataFrame:
    """Trips from one station to another page by page, by departure time."""
    span = TimeRange.of(start, end)
    starts, ends, *_ = asked_ends(data, {"start_gantry": gantry_o, "end_gantry": gantry_d})
    vehicles = flow.any_of(vehicle_type)
    return trips.detail_page(data.trips(span), span, starts, ends,
                             [int(v) for v in vehicles] if vehicles else None,
                             limit, offset)


def detections_pages(data: TrafficData, start: str, end: str, gantry: str = "all",
                     vehicle_type: str = "all") -> Pages:
    """Detection rows under an index that gives pages at any offset; the index is built when called."""
    span = TimeRange.of(start, end)
    vehicles = flow.any_of(vehicle_type)
    return flow.detail_pages(
        data.detections(span), span, stations=flow.any_of(gantry), alias=data.aliases,
        vehicles=[int(v) for v in vehicles] if vehicles else None)


def trips_pages(data: TrafficData, start: str, end: str, gantry_o: str, gantry_d: str,
                vehicle_type: str = "all") -> Pages:
    """Trips from one station to another under an index, by departure time."""
    span = TimeRange.of(start, end)
    starts, ends, *_ = asked_ends(data, {"start_gantry": gantry_o, "end_gantry": gantry_d})
    vehicles = flow.any_of(vehicle_type)
    return trips.detail_pages(data.trips(span), span, starts, ends,
                              [int(v) for v in vehicles] if vehicles else None)


def dashboard(data: TrafficData, payload: dict, max_days: int | None = None) -> DataFrame:
    """Statistics of a day, week or month as one table, see :func:`stats.dashboard`.

    One action and one scan give all panels; :func:`stats.panel` takes one out.
    """
    period = payload.get("period_type")
    if period not in ("daily", "weekly", "monthly"):
        raise ValueError("period_type must be daily, weekly or monthly")
    span = TimeRange.days(payload["start_date"], payload["end_date"]).check(max_days)
    fine = stats.base(data.detections(span), span, hourly=period == "daily")
    return stats.dashboard(fine, data.known_sections())


def dashboard_answer(data: TrafficData, payload: dict, max_days: int | None = None) -> DataFrame:
    """The dashboard as it is shown, see :func:`stats.answer`, with the label of its period."""
    period = payload.get("period_type")
    if period not in ("daily", "weekly", "monthly"):
        raise ValueError("period_type must be daily, weekly or monthly")
    first, last = parse_day(payload["start_date"]), parse_day(payload["end_date"])
    span = TimeRange.days(payload["start_date"], payload["end_date"]).check(max_days)
    fine = stats.base(data.detections(span), span, hourly=period == "daily")
    return stats.answer(fine, data.known_sections()).withColumn(
        "label", period_label(F.lit(period), F.lit(first), F.lit(last)))


def week_of(day: str) -> tuple[date, date]:
    """Sunday to Saturday around a day, for a weekly request."""
    at = parse_day(day)
    sunday = at - timedelta(days=(at.weekday() + 1) % 7)
    return sunday, sunday + timedelta(days=6)
