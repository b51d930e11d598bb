"""Flow and dashboard queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.timeparts import TimeRange
from roadpulse.operators import flow, pages, stats
from roadpulse.plans import service
from roadpulse.registry.book import (ALIAS, DETECTIONS, GROUPS, SECTIONS, registered,
                                     with_views)
from roadpulse.registry.facts import alias_index_of, data_of, detections_of, lookup_of, sections_of

MONTH = TimeRange.of("2024-01-01 00:00", "2024-01-30 23:59")
STATIONS = ["01F0230N", "01F0345S", "03F1265S"]


def series_sql(low: str, high: str, bucket: str, where: str = "TRUE", station: str = "g",
               views: tuple[str, ...] = (DETECTIONS,)) -> str:
    return with_views(*views, select=f"""
        SELECT {bucket} AS "time", {station} AS gantry_id, dir AS direction,
               CAST(vt AS VARCHAR) AS vehicle_type, CAST(sum(vol) AS BIGINT) AS traffic_volume
        FROM det WHERE ti BETWEEN '{low}' AND '{high}' AND {where} GROUP BY ALL""")


HOUR, DAY = "substr(ti, 1, 13) || ':00'", "substr(ti, 1, 10)"
_LISTED = "g IN ('01F0230N', '01F0345S', '03F1265S')"


def series_of(spark, sf_dir, span, **filters):
    return flow.series(detections_of(spark, sf_dir, span), span, **filters)


@registered(series_sql("2024-01-10 00:00", "2024-01-11 23:55", "ti", _LISTED))
def flow_5min(spark, sf_dir):
    """Under two days with stations: the 5-minute slots themselves."""
    return series_of(spark, sf_dir, TimeRange.of("2024-01-10 00:00", "2024-01-11 23:55"),
                     stations=STATIONS)


@registered(series_sql("2024-01-10 00:00", "2024-01-12 00:00", "ti", _LISTED))
def flow_exactly_two_days(spark, sf_dir):
    return series_of(spark, sf_dir, TimeRange.of("2024-01-10 00:00", "2024-01-12 00:00"),
                     stations=STATIONS)


@registered(series_sql("2024-01-03 00:00", "2024-01-03 23:59", HOUR))
def flow_day_all_stations(spark, sf_dir):
    """One day without a station: hours."""
    return series_of(spark, sf_dir, TimeRange.of("2024-01-03 00:00", "2024-01-03 23:59"))


@registered(series_sql("2024-01-03 00:00", "2024-01-17 00:00", HOUR, "dir = 'N' AND vt = 31"))
def flow_hourly(spark, sf_dir):
    """Exactly fourteen days: still hours; one direction and vehicle."""
    return series_of(spark, sf_dir, TimeRange.of("2024-01-03 00:00", "2024-01-17 00:00"),
                     direction="N", vehicle=31)


@registered(series_sql("2024-01-01 00:00", "2024-01-30 23:59", DAY))
def flow_daily(spark, sf_dir):
    return series_of(spark, sf_dir, MONTH)


@registered(series_sql("2024-01-01 00:00", "2024-01-30 23:59", DAY,
                       "g IN (SELECT id FROM alias WHERE component = (SELECT component FROM alias"
                       " WHERE id = '01F0460N'))", "'01F0460N'", (DETECTIONS, ALIAS)))
def flow_alias_expanded(spark, sf_dir):
    """One series across a renumbering, under the id that was asked for."""
    return series_of(spark, sf_dir, MONTH, stations=["01F0460N"], alias=alias_index_of(spark, sf_dir))


@registered(series_sql("2024-01-01 00:00", "2024-01-30 23:59", DAY,
                       "g IN ('01F0459N', '01F0460N', '01F0230N')"))
def flow_alias_attributed(spark, sf_dir):
    """Both ids asked for: neither is rewritten."""
    return series_of(spark, sf_dir, MONTH, stations=["01F0459N", "01F0460N", "01F0230N"],
                     alias=alias_index_of(spark, sf_dir))


@registered(with_views(DETECTIONS, select="""
    SELECT ti AS "TimeInterval", g AS "GantryID", dir AS "Direction", vt AS "VehicleType",
           vol AS "Volume"
    FROM det WHERE ti BETWEEN '2024-01-05 00:00' AND '2024-01-25 23:59' AND vt IN (31, 5)
    ORDER BY ti, g, dir, vt, vol LIMIT 300 OFFSET 600"""))
def flow_detail_page(spark, sf_dir):
    span = TimeRange.of("2024-01-05 00:00", "2024-01-25 23:59")
    return flow.detail_page(detections_of(spark, sf_dir, span), span, 300, 600,
                            vehicles=[31, 5])


@registered(with_views(DETECTIONS, select="""
    , o AS (SELECT *, row_number() OVER (ORDER BY ti, g, dir, vt, vol) AS nth,
                   count(*) OVER () AS total FROM det)
    SELECT total, ti AS "TimeInterval", g AS "GantryID", dir AS "Direction", vt AS "VehicleType",
           vol AS "Volume" FROM o WHERE nth > total * 3 // 4 AND nth <= total * 3 // 4 + 500"""))
def flow_far_page(spark, sf_dir):
    """A page three quarters down all detections, by the index of their pages."""
    rows = detections_of(spark, sf_dir)
    found = pages.index(rows.select("TimeInterval", "GantryID", "Direction", "VehicleType", "Volume"),
                        ["TimeInterval", "GantryID", "Direction", "VehicleType", "Volume"])
    total = found.total()
    return found.page(500, total * 3 // 4).withColumn("total", F.lit(total).cast("long"))


@registered(with_views(DETECTIONS, select=f"""
    , r AS (SELECT {HOUR} AS "time", g AS gantry_id, dir AS direction,
                   CAST(vt AS VARCHAR) AS vehicle_type, CAST(sum(vol) AS BIGINT) AS traffic_volume
            FROM det WHERE ti BETWEEN '2024-01-03 00:00' AND '2024-01-09 23:59' GROUP BY ALL)
    SELECT * FROM r"""))
def flow_capped_report(spark, sf_dir):
    """A report, whole: what is shown of it is up to the caller."""
    return series_of(spark, sf_dir, TimeRange.of("2024-01-03 00:00", "2024-01-09 23:59"))


@registered(with_views(DETECTIONS, select="""
    , s AS (SELECT ti, sum(vol) AS v FROM det GROUP BY ti)
    SELECT CAST((SELECT sum(vol) FROM det) AS BIGINT) AS total_volume,
           (SELECT sum(vol) FROM det) / (SELECT count(DISTINCT substr(ti, 1, 10)) FROM det)::DOUBLE
               AS mean_per_day,
           (SELECT count(DISTINCT g) FROM det) AS stations,
           (SELECT ti FROM s ORDER BY v DESC, ti LIMIT 1) AS peak_time,
           CAST((SELECT max(v) FROM s) AS BIGINT) AS peak_volume"""))
def flow_metrics(spark, sf_dir):
    rows = detections_of(spark, sf_dir)
    return flow.metrics(renamed(rows))


def renamed(rows: DataFrame) -> DataFrame:
    """Detections under the names of a query result."""
    return rows.select(F.col("TimeInterval").alias("time"), F.col("GantryID").alias("gantry_id"),
                       F.col("Direction").alias("direction"),
                       F.col("VehicleType").cast("string").alias("vehicle_type"),
                       F.col("Volume").alias("traffic_volume"))


@registered(with_views(DETECTIONS, select="""
    SELECT CAST(vt AS VARCHAR) AS vehicle_type, CAST(sum(vol) AS BIGINT) AS volume,
           round(sum(vol) / (SELECT sum(vol) FROM det)::DOUBLE * 100, 1) AS share,
           sum(vol) / (SELECT count(DISTINCT substr(ti, 1, 10)) FROM det)::DOUBLE AS mean_per_day
    FROM det GROUP BY vt"""))
def flow_vehicle_breakdown(spark, sf_dir):
    return flow.vehicle_breakdown(renamed(detections_of(spark, sf_dir)))


@registered(with_views(DETECTIONS, GROUPS, select="""
    , r AS (SELECT group_id AS key, cur AS gantry_id, nm AS name, gdir AS direction,
                   CAST(sum(vol) AS BIGINT) AS volume
            FROM det JOIN mem ON mem.station = det.g GROUP BY ALL)
    SELECT *, round(volume / (SELECT sum(volume) FROM r)::DOUBLE * 100, 1) AS share,
           CAST(row_number() OVER (ORDER BY volume DESC, key) AS INTEGER) AS rank
    FROM r ORDER BY volume DESC, key LIMIT 12"""))
def flow_station_ranking(spark, sf_dir):
    return flow.station_ranking(renamed(detections_of(spark, sf_dir)),
                                lookup_of(spark, sf_dir), 12)


@registered(with_views(DETECTIONS, select="""
    SELECT g || '|||' || dir AS key, g AS gantry_id, g AS name, dir AS direction,
           CAST(sum(vol) AS BIGINT) AS volume,
           round(sum(vol) / (SELECT sum(vol) FROM det)::DOUBLE * 100, 1) AS share,
           CAST(row_number() OVER (ORDER BY sum(vol) DESC, g || '|||' || dir) AS INTEGER) AS rank
    FROM det GROUP BY g, dir ORDER BY rank LIMIT 50"""))
def flow_station_ranking_ungrouped(spark, sf_dir):
    """Stations that belong to no section rank per station and direction."""
    nobody = lookup_of(spark, sf_dir).filter("station = ''")
    return flow.station_ranking(renamed(detections_of(spark, sf_dir)), nobody, 50)


@registered(with_views(DETECTIONS, select=f"""
    SELECT {HOUR} AS bucket, CAST(sum(vol) AS BIGINT) AS volume FROM det
    WHERE ti BETWEEN '2024-01-03 00:00' AND '2024-01-17 00:00' GROUP BY 1"""))
def flow_trend(spark, sf_dir):
    """Trend table."""
    span = TimeRange.of("2024-01-03 00:00", "2024-01-17 00:00")
    return flow.trend(renamed(flow.selected(detections_of(spark, sf_dir, span), span)),
                      span)


@registered(with_views(DETECTIONS, GROUPS, select="""
    SELECT ti AS "time", g AS gantry_id, coalesce(nm, g) AS gantry_name, dir AS direction,
           CAST(vt AS VARCHAR) AS vehicle_type, CAST(vol AS DOUBLE) * 1000 AS volume
    FROM det LEFT JOIN mem ON mem.station = det.g"""))
def detections_normalized(spark, sf_dir):
    """Columns under other spellings, a number with a thousands comma, no direction column."""
    rows = detections_of(spark, sf_dir)
    other = rows.select(
        F.lit("").alias("time"), F.concat(F.lit(" "), "TimeInterval").alias("TimeInterval"),
        F.col("GantryID").alias("etc_gantry_id"),
        F.col("VehicleType").alias("car_type"),
        F.concat(F.col("Volume").cast("string"), F.lit(",000")).alias("flow"))
    return flow.normalized(other, lookup_of(spark, sf_dir))


def base_of(spark, sf_dir, first, last, hourly=False):
    span = TimeRange.days(first, last)
    return stats.base(detections_of(spark, sf_dir, span), span, hourly)


def _in_days(first: str, last: str) -> str:
    return f"ti BETWEEN '{first} 00:00' AND '{last} 23:59'"


@registered(with_views(DETECTIONS, select=f"""
    SELECT CAST(sum(vol) AS BIGINT) AS total_volume, count(*) AS row_count FROM det
    WHERE {_in_days("2024-01-01", "2024-01-31")}"""))
def stats_total(spark, sf_dir):
    return stats.total(base_of(spark, sf_dir, "2024-01-01", "2024-01-31"))


@registered(with_views(DETECTIONS, select=f"""
    SELECT {HOUR} AS "time", CAST(sum(vol) AS BIGINT) AS volume FROM det
    WHERE {_in_days("2024-01-15", "2024-01-15")} GROUP BY 1"""))
def stats_hourly(spark, sf_dir):
    return stats.hourly_series(base_of(spark, sf_dir, "2024-01-15", "2024-01-15", hourly=True))


@registered(with_views(DETECTIONS, select=f"""
    SELECT {DAY} AS "date", CAST(sum(vol) AS BIGINT) AS volume FROM det
    WHERE {_in_days("2024-01-07", "2024-01-13")} GROUP BY 1"""))
def stats_daily(spark, sf_dir):
    """A week, Sunday to Saturday."""
    return stats.daily_series(base_of(spark, sf_dir, "2024-01-07", "2024-01-13"))


@registered(with_views(DETECTIONS, select=f"""
    SELECT CAST(code AS VARCHAR) AS vehicle_type, CAST(coalesce(v, 0) AS BIGINT) AS volume,
           round(coalesce(v, 0) / (SELECT sum(vol) FROM det)::DOUBLE * 100, 1) AS share
    FROM (VALUES (31), (32), (41), (42), (5)) AS domain(code)
    LEFT JOIN (SELECT vt, sum(vol) AS v FROM det
               WHERE {_in_days("2024-01-01", "2024-01-31")} GROUP BY vt) ON vt = code"""))
def stats_vehicle_share(spark, sf_dir):
    return stats.vehicle_share_ordered(base_of(spark, sf_dir, "2024-01-01", "2024-01-31"))


@registered(with_views(DETECTIONS, ALIAS, SECTIONS, select="""
    , r AS (
        SELECT coalesce(a.group_id, b.group_id, 'RAW_' || g) AS group_id,
               min(coalesce(a.cur, b.cur, g)) AS gantry_id, min(coalesce(a.nm, b.nm, g)) AS name,
               min(coalesce(a.gdir, b.gdir, dir)) AS direction, CAST(sum(vol) AS BIGINT) AS volume
        FROM (SELECT * REPLACE (CASE WHEN dir = 'S' THEN 'S' ELSE 'N' END AS dir) FROM det)
        LEFT JOIN mem a ON a.station = g LEFT JOIN alias ON alias.id = g
        LEFT JOIN mem b ON b.station = alias.canonical GROUP BY 1)
    SELECT *, CASE direction WHEN 'S' THEN '南下' ELSE '北上' END AS direction_label,
           round(volume / (SELECT sum(volume) FROM r)::DOUBLE * 100, 1) AS share
    FROM r ORDER BY volume DESC, name, direction LIMIT 10"""))
def stats_road_ranking(spark, sf_dir):
    """Month ranking of road sections, renumbered stations counted with their successor."""
    return stats.road_ranking(base_of(spark, sf_dir, "2024-01-01", "2024-01-31"),
                              sections_of(spark, sf_dir))


@registered(with_views(DETECTIONS, select=f"""
    , d AS (SELECT * FROM det WHERE {_in_days("2024-01-01", "2024-01-31")})
    SELECT panel, key, CAST(volume AS BIGINT) AS volume, row_count FROM (
        SELECT 'total' AS panel, '' AS key, sum(vol) AS volume, count(*) AS row_count FROM d
        UNION ALL SELECT 'bucket', {HOUR}, sum(vol), count(*) FROM d GROUP BY 2
        UNION ALL SELECT 'day', {DAY}, sum(vol), count(*) FROM d GROUP BY 2
        UNION ALL SELECT 'vehicle', CAST(vt AS VARCHAR), sum(vol), count(*) FROM d GROUP BY 2
        UNION ALL SELECT 'station', g || '|' || dir, sum(vol), count(*) FROM d GROUP BY 2)"""))
def stats_panels(spark, sf_dir):
    """All dashboard sums from one pass over the detections."""
    table = stats.panels(base_of(spark, sf_dir, "2024-01-01", "2024-01-31", hourly=True))
    key = F.concat_ws("|", "bucket", "day", F.col("VehicleType").cast("string"), "GantryID",
                      "Direction")
    return table.select("panel", key.alias("key"), "volume", "row_count")


@registered(with_views(DETECTIONS, ALIAS, SECTIONS, select=f"""
    , d AS (SELECT det.*, coalesce(a.group_id, b.group_id, 'RAW_' || g) AS section
            FROM det LEFT JOIN mem a ON a.station = g LEFT JOIN alias ON alias.id = g
            LEFT JOIN mem b ON b.station = alias.canonical
            WHERE {_in_days("2024-01-01", "2024-01-31")})
    SELECT panel, key, CAST(volume AS BIGINT) AS volume, row_count,
           round(volume / (SELECT sum(vol) FROM d)::DOUBLE * 100, 1) AS share FROM (
        SELECT 'total' AS panel, '' AS key, sum(vol) AS volume, count(*) AS row_count FROM d
        UNION ALL SELECT 'bucket', {DAY}, sum(vol), count(*) FROM d GROUP BY 2
        UNION ALL SELECT 'day', {DAY}, sum(vol), count(*) FROM d GROUP BY 2
        UNION ALL SELECT 'vehicle', CAST(vt AS VARCHAR), sum(vol), count(*) FROM d GROUP BY 2
        UNION ALL SELECT 'section', section, sum(vol), count(*) FROM d GROUP BY 2)"""))
def dashboard(spark, sf_dir):
    """The whole answer to a month's dashboard request, in one action."""
    return service.dashboard(data_of(spark, sf_dir), {
        "period_type": "monthly", "start_date": "2024-01-01", "end_date": "2024-01-31"})


def _answer_sql(low: str, high: str, label: str, hourly: bool) -> str:
    hours = f"UNION ALL SELECT 'hour', {HOUR}, sum(vol), count(*) FROM d GROUP BY 2" if hourly else ""
    return with_views(DETECTIONS, ALIAS, SECTIONS, select=f"""
    , d AS (SELECT det.*, coalesce(a.group_id, b.group_id, 'RAW_' || g) AS section,
                   coalesce(a.cur, b.cur, g) AS cur, coalesce(a.nm, b.nm, g) AS nm,
                   coalesce(a.gdir, b.gdir, CASE dir WHEN 'S' THEN 'S' ELSE 'N' END) AS way
            FROM det LEFT JOIN mem a ON a.station = g LEFT JOIN alias ON alias.id = g
            LEFT JOIN mem b ON b.station = alias.canonical WHERE {_in_days(low, high)}),
      kinds AS (SELECT unnest([31, 32, 41, 42, 5]) AS code, unnest(range(1, 6)) AS place),
      panels AS (
        SELECT 'total' AS panel, '' AS key, sum(vol) AS volume, count(*) AS row_count,
               NULL AS gantry_id, NULL AS name, NULL AS direction, 1 AS place FROM d
        UNION ALL SELECT 'vehicle', CAST(code AS VARCHAR), coalesce(sum(vol), 0), count(vt), NULL, NULL, NULL,
               place FROM kinds LEFT JOIN d ON vt = code GROUP BY code, place
        UNION ALL SELECT 'section', section, sum(vol), count(*), min(cur), min(nm), min(way),
               row_number() OVER (ORDER BY sum(vol) DESC, min(nm), min(way), section) FROM d GROUP BY 2
        UNION ALL SELECT panel, key, volume, row_count, NULL, NULL, NULL,
               row_number() OVER (PARTITION BY panel ORDER BY key) FROM (
            SELECT 'day' AS panel, {DAY} AS key, sum(vol) AS volume, count(*) AS row_count FROM d GROUP BY 2
            {hours}))
    SELECT panel, key, CAST(volume AS BIGINT) AS volume, row_count, gantry_id, name, direction,
           CASE direction WHEN 'S' THEN '南下' WHEN 'N' THEN '北上' END AS direction_label,
           CAST(place AS INTEGER) AS place, '{label}' AS label,
           round(volume / (SELECT sum(vol) FROM d)::DOUBLE * 100, 1) AS share
    FROM panels WHERE panel <> 'section' OR place <= 10""")


@registered(_answer_sql("2024-01-01", "2024-01-31", "月流量｜2024/01/01 ～ 2024/01/31", hourly=False))
def dashboard_month(spark, sf_dir):
    """A month's dashboard as shown: named and ordered sections, all vehicle types, days."""
    return service.dashboard_answer(data_of(spark, sf_dir), {
        "period_type": "monthly", "start_date": "2024-01-01", "end_date": "2024-01-31"})


@registered(_answer_sql("2024-01-10", "2024-01-10", "日流量｜2024/01/10", hourly=True))
def dashboard_day(spark, sf_dir):
    """A day's dashboard as shown, with its hours."""
    return service.dashboard_answer(data_of(spark, sf_dir), {
        "period_type": "daily", "start_date": "2024-01-10", "end_date": "2024-01-10"})


@registered(series_sql("2024-01-10 00:00", "2024-01-11 23:55", "ti", _LISTED))
def flow_answer(spark, sf_dir):
    """A flow request answered, in time and station order."""
    return service.query(data_of(spark, sf_dir), {
        "dataset": "M03A", "start_time": "2024-01-10 00:00", "end_time": "2024-01-11 23:55",
        "gantry_ids": STATIONS}).rows
