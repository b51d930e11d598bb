"""Trip and OD queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.functions.timeparts import TimeRange
from roadpulse.operators import trips
from roadpulse.operators.alias import expanded_ids
from roadpulse.operators.quality import value_counts
from roadpulse.plans import service
from roadpulse.registry.book import TRIPS, registered, with_views
from roadpulse.registry.facts import alias_index_of, data_of, trips_of

MONTH = TimeRange.of("2024-01-01 00:00:00", "2024-01-30 23:59:59")
WEEK = TimeRange.of("2024-01-08 00:00:00", "2024-01-14 23:59:59")
# northbound: over the renumbered station 4 down to 2 and 0
STARTS, ENDS = ["01F0460N", "01F0690N"], ["01F0230N", "01F0000N"]
_TS = "[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}"
_A, _B = "01F0460N|01F0459N|01F0690N", "01F0230N|01F0000N"
_HIT = f"regexp_matches(path, '({_A}).*({_B})')"


def ends_of(spark, sf_dir):
    return expanded_ids(alias_index_of(spark, sf_dir), STARTS, ENDS)


def matched_sql(low: str, high: str, where: str = "TRUE") -> str:
    pattern = f"({_TS})\\+(?:{_A}).*({_TS})\\+(?:{_B})"
    return f""", hit0 AS (
        SELECT *, regexp_extract(path, '{pattern}', 1) AS ta,
               regexp_extract(path, '{pattern}', 2) AS tb
        FROM trp WHERE {where}),
      hit AS (
        SELECT *, CAST(epoch(tb::TIMESTAMP) - epoch(ta::TIMESTAMP) AS BIGINT) AS secs
        FROM hit0 WHERE ta <> '' AND ta BETWEEN '{low}' AND '{high}'),
      od AS (
        SELECT substr(ta, 1, 14) || lpad(CAST(CAST(substr(ta, 15, 2) AS INTEGER) // 15 * 15
                                              AS VARCHAR), 2, '0') AS origin_time,
               CAST(vt AS VARCHAR) AS vehicle_type, count(*) AS trip_count,
               CAST(sum(secs) AS BIGINT) AS sum_seconds
        FROM hit GROUP BY ALL)"""


MONTH_SQL = matched_sql("2024-01-01 00:00:00", "2024-01-30 23:59:59")
WEEK_SQL = matched_sql("2024-01-08 00:00:00", "2024-01-14 23:59:59")


def od_rows(spark, sf_dir, span=MONTH, vehicle=None):
    return trips.travel_time(trips.stretches(
        trips_of(spark, sf_dir, span), span, *ends_of(spark, sf_dir), vehicle))


@registered(with_views(TRIPS, select=f"""
    SELECT vt AS "VehicleType", time_o AS "DetectionTimeO", g_o AS "GantryO",
           time_d AS "DetectionTimeD", g_d AS "GantryD", len AS "TripLength", fin AS "TripEnd",
           path AS "TripInformation"
    FROM trp WHERE {_HIT} AND time_o BETWEEN '2024-01-01 00:00:00' AND '2024-01-30 23:59:59'
    ORDER BY time_o, vt, g_o, time_d, g_d, len, fin, path LIMIT 200 OFFSET 20"""))
def trip_detail_page(spark, sf_dir):
    return trips.detail_page(trips_of(spark, sf_dir, MONTH), MONTH,
                             *ends_of(spark, sf_dir), limit=200, offset=20)


@registered(with_views(TRIPS, select=f"""
    , o AS (SELECT *, row_number() OVER (ORDER BY time_o, vt, g_o, time_d, g_d, len, fin, path) AS nth,
                   count(*) OVER () AS total
            FROM trp WHERE {_HIT} AND time_o BETWEEN '2024-01-01 00:00:00' AND '2024-01-30 23:59:59')
    SELECT vt AS "VehicleType", time_o AS "DetectionTimeO", g_o AS "GantryO",
           time_d AS "DetectionTimeD", g_d AS "GantryD", len AS "TripLength", fin AS "TripEnd",
           path AS "TripInformation" FROM o WHERE nth > total - 150"""))
def trip_last_page(spark, sf_dir):
    """The last page of a month's trips, by the index of their pages."""
    found = trips.detail_pages(trips_of(spark, sf_dir, MONTH), MONTH, *ends_of(spark, sf_dir))
    total = found.total()
    return found.page(150, max(0, total - 150))


@registered(with_views(TRIPS, select=f"""
    SELECT time_o, g_o, g_d, path FROM trp WHERE {_HIT}"""))
def od_pass_filter(spark, sf_dir):
    """All trips that pass a start before an end, both ids of a renumbered station."""
    return trips.passing(trips_of(spark, sf_dir), *ends_of(spark, sf_dir)).select(
        F.col("DetectionTime_O").alias("time_o"), F.col("GantryID_O").alias("g_o"),
        F.col("GantryID_D").alias("g_d"), F.col("TripInformation").alias("path"))


@registered(with_views(TRIPS, select=MONTH_SQL + """
    SELECT *, round(sum_seconds / (trip_count * 60.0::DOUBLE), 1) AS avg_travel_time_minutes
    FROM od"""))
def od_travel_time(spark, sf_dir):
    return od_rows(spark, sf_dir)


@registered(with_views(TRIPS, select=matched_sql(
    "2024-01-08 00:00:00", "2024-01-14 23:59:59", "vt = 41") + """
    SELECT *, round(sum_seconds / (trip_count * 60.0::DOUBLE), 1) AS avg_travel_time_minutes
    FROM od"""))
def od_travel_time_vehicle(spark, sf_dir):
    return od_rows(spark, sf_dir, WEEK, 41)


@registered(with_views(TRIPS, select=MONTH_SQL + """
    SELECT substr(origin_time, 1, 10) AS bucket, vehicle_type,
           CAST(sum(trip_count) AS BIGINT) AS trip_count FROM od GROUP BY ALL"""))
def od_trend_vehicle(spark, sf_dir):
    """A month: days."""
    return trips.totals_by_time(od_rows(spark, sf_dir), MONTH)


@registered(with_views(TRIPS, select=WEEK_SQL + """
    SELECT substr(origin_time, 1, 13) || ':00' AS bucket, vehicle_type,
           CAST(sum(trip_count) AS BIGINT) AS trip_count FROM od GROUP BY ALL"""))
def od_trend_week(spark, sf_dir):
    """A week: hours."""
    return trips.totals_by_time(od_rows(spark, sf_dir, WEEK), WEEK)


@registered(with_views(TRIPS, select=MONTH_SQL + """
    SELECT vehicle_type, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM od GROUP BY 1"""))
def od_vehicle_totals(spark, sf_dir):
    return trips.totals_by_vehicle(od_rows(spark, sf_dir))


_PIVOT = ", ".join(
    f"CAST(coalesce(sum(trip_count) FILTER (vehicle_type = '{v}'), 0) AS BIGINT) AS v{v}"
    for v in (31, 32, 41, 42, 5))


@registered(with_views(TRIPS, select=MONTH_SQL + f"""
    SELECT substr(origin_time, 1, 10) AS bucket, {_PIVOT},
           CAST(sum(trip_count) AS BIGINT) AS total FROM od GROUP BY 1"""))
def od_pivot(spark, sf_dir):
    """Time by vehicle table."""
    return trips.pivot(od_rows(spark, sf_dir), MONTH)


@registered(with_views(TRIPS, select=MONTH_SQL + f"""
    , d AS (SELECT substr(origin_time, 1, 10) AS b, sum(trip_count) AS n FROM od GROUP BY 1),
      v AS (SELECT vehicle_type AS v, sum(trip_count) AS n FROM od GROUP BY 1)
    SELECT CAST((SELECT sum(n) FROM v) AS BIGINT) AS trips,
           (SELECT sum(n) FROM v) / {MONTH.span_hours!r}::DOUBLE AS mean_per_hour,
           (SELECT b FROM d ORDER BY n DESC, b LIMIT 1) AS peak_time,
           CAST((SELECT max(n) FROM d) AS BIGINT) AS peak_trips,
           (SELECT v FROM v ORDER BY n DESC, v LIMIT 1) AS main_vehicle,
           CAST((SELECT max(n) FROM v) AS BIGINT) AS main_trips,
           round((SELECT max(n) FROM v) / (SELECT sum(n) FROM v)::DOUBLE * 100, 1)
               AS main_share"""))
def od_metrics(spark, sf_dir):
    return trips.metrics(od_rows(spark, sf_dir), MONTH)


@registered(with_views(TRIPS, select=MONTH_SQL + """
    SELECT sum(sum_seconds)::DOUBLE / (sum(trip_count) * 60.0::DOUBLE) AS mean_minutes,
           CAST(sum(trip_count) AS BIGINT) AS trips FROM od"""))
def od_weighted_mean(spark, sf_dir):
    """Mean travel time over all trips from whole seconds, rounded nowhere."""
    return trips.mean_travel_minutes(od_rows(spark, sf_dir))


_ROUTES = f"""
    , pos AS (
        SELECT rid, i, st, regexp_matches(st, '^({_A})$') AS a, regexp_matches(st, '^({_B})$') AS b
        FROM leg),
      cut AS (
        SELECT rid, min(i) FILTER (a) AS fst, max(i) FILTER (b) AS lst FROM pos GROUP BY rid),
      rt AS (
        SELECT rid, string_agg(st, ',' ORDER BY i) AS route FROM pos JOIN cut USING (rid)
        WHERE fst < lst AND i BETWEEN fst AND lst GROUP BY rid)
    SELECT route, count(*) AS trips FROM rt GROUP BY route"""


@registered(with_views(TRIPS, select=_ROUTES))
def od_routes(spark, sf_dir):
    """Every driven station sequence from start to end with its trips."""
    return trips.route_counts(trips_of(spark, sf_dir), *ends_of(spark, sf_dir))


@registered(with_views(TRIPS, select=_ROUTES + " ORDER BY trips DESC, route LIMIT 1"))
def od_modal_route(spark, sf_dir):
    return trips.modal_route(trips_of(spark, sf_dir), *ends_of(spark, sf_dir))


@registered(with_views(TRIPS, select=MONTH_SQL + f"""
    , pos AS (SELECT *, regexp_full_match(st, '{_A}') AS a, regexp_full_match(st, '{_B}') AS b FROM leg),
      cut AS (SELECT rid, min(i) FILTER (a) AS fst, max(i) FILTER (b) AS lst,
                     arg_min(lt, i) FILTER (a) AS ta, arg_max(lt, i) FILTER (b) AS tb
              FROM pos GROUP BY rid),
      rt AS (SELECT rid, string_agg(st, ',' ORDER BY i) AS route,
                    any_value(epoch(tb::TIMESTAMP) - epoch(ta::TIMESTAMP)) AS secs
             FROM pos JOIN cut USING (rid)
             WHERE fst < lst AND i BETWEEN fst AND lst
               AND ta BETWEEN '2024-01-01 00:00:00' AND '2024-01-30 23:59:59' GROUP BY rid),
      top AS (SELECT route, count(*) AS n, CAST(sum(secs) AS BIGINT) AS s
              FROM rt GROUP BY route ORDER BY n DESC, route LIMIT 1)
    SELECT 'time' AS part, origin_time, vehicle_type, trip_count, NULL AS route,
           round(sum_seconds / (trip_count * 60.0::DOUBLE), 1) AS avg_travel_time_minutes FROM od
    UNION ALL
    SELECT 'route', NULL, NULL, n, route, round(s / (n * 60.0::DOUBLE), 1) FROM top"""))
def od_request(spark, sf_dir):
    """A month of an OD pair: rows and modal route by one scan of the paths."""
    starts, ends = ends_of(spark, sf_dir)
    return trips.answer(trips.stretches(trips_of(spark, sf_dir, MONTH), MONTH, starts, ends),
                        starts, ends)


@registered(with_views(TRIPS, select="""
    SELECT t AS time_o, vt AS vehicle, CAST(i + 1 AS INTEGER) AS position, lt AS "time",
           st AS station FROM leg"""))
def trip_legs(spark, sf_dir):
    """Every passed station of every trip."""
    rows = trips_of(spark, sf_dir).select(
        F.col("DetectionTime_O").alias("time_o"), F.col("VehicleType").alias("vehicle"),
        "TripInformation")
    return trips.trip_legs(rows)


@registered(with_views(TRIPS, select="""
    SELECT time_o AS origin_time, time_d AS destination_time, g_o AS start_gantry,
           'X' AS end_gantry, CAST(vt AS VARCHAR) AS vehicle_type, 1.0::DOUBLE AS trip_count,
           CASE vt WHEN 31 THEN len WHEN 32 THEN 61.5 WHEN 41 THEN 2.5
                WHEN 42 THEN len * 23 / 60.0
                ELSE (epoch(time_d::TIMESTAMP) - epoch(time_o::TIMESTAMP)) / 60.0
           END::DOUBLE AS travel_minutes
    FROM trp"""))
def trips_normalized(spark, sf_dir):
    """Other spellings; minutes as a number, H:MM:SS or M:SS, else seconds, else the two times."""
    v, length = F.col("VehicleType"), F.col("TripLength")
    rows = trips_of(spark, sf_dir).select(
        F.col("DetectionTime_O").alias("entry_time"), F.col("DetectionTime_D").alias("exit_time"),
        F.col("GantryID_O").alias("gantry_from"), F.lit(None).cast("string").alias("gantry_to"),
        v.alias("car_type"),
        F.when(v == 31, length.cast("string")).when(v == 32, "1:01:30").when(v == 41, "2:30")
        .when(v == 42, "none").otherwise("").alias("travel_time"),
        F.when(v == 42, length * 23).alias("duration_seconds"))
    return trips.normalized(rows, end="X")


@registered(with_views(TRIPS, select="""
    SELECT fin AS "TripEnd", count(*) AS "count" FROM trp GROUP BY fin"""))
def trip_end_counts(spark, sf_dir):
    return value_counts(trips_of(spark, sf_dir), "TripEnd")


@registered(with_views(TRIPS, select=WEEK_SQL + f"""
    SELECT origin_time, vehicle_type, trip_count, '{STARTS[0]}' AS start_gantry, '{ENDS[0]}' AS end_gantry,
           round(sum_seconds / (trip_count * 60.0::DOUBLE), 1) AS avg_travel_time_minutes FROM od"""))
def od_answer(spark, sf_dir):
    """An OD request answered, in time and vehicle order."""
    return service.query(data_of(spark, sf_dir), {
        "dataset": "M06A", "start_time": "2024-01-08 00:00:00", "end_time": "2024-01-14 23:59:59",
        "start_gantry_ids": STARTS, "end_gantry_ids": ENDS}).rows
