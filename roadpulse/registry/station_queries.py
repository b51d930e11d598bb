"""Station, alias, OD-pair and route queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from roadpulse import fixtures
from roadpulse.functions.paths import station_ids
from roadpulse.operators import alias as al
from roadpulse.operators import routes, stations, stats
from roadpulse.registry.book import (ALIAS, DETECTIONS, EVENTS, GROUPS, TRIPS, registered,
                                     with_views)
from roadpulse.registry.facts import (alias_of, detections_of, groups_of, lookup_of,
                                      trips_of)


@registered(with_views(EVENTS, ALIAS, select="SELECT id, component, members FROM alias"))
def alias_groups(spark, sf_dir):
    return alias_of(spark, sf_dir).select("id", "component", "members")


@registered(with_views(EVENTS, ALIAS, select="SELECT id, canonical FROM alias"))
def alias_canonical(spark, sf_dir):
    return alias_of(spark, sf_dir).select("id", "canonical")


@registered(with_views(EVENTS, ALIAS, select="""
    , asked AS (SELECT st AS asked FROM hist)
    SELECT asked AS id, asked FROM asked
    UNION ALL
    SELECT m.id, max(asked) FROM asked JOIN alias a ON a.id = asked
    JOIN alias m ON m.component = a.component
    WHERE m.id NOT IN (SELECT asked FROM asked) GROUP BY m.id"""))
def alias_expansion(spark, sf_dir):
    """Asked ids and their aliases; the request is every station seen, in id order."""
    asked = fixtures.station_history(spark, sf_dir).select(
        F.col("station").alias("asked"), F.lit(0).alias("position"))
    return al.expansion(alias_of(spark, sf_dir), asked).select("id", "asked")


@registered(with_views(EVENTS, GROUPS, select="""
    SELECT group_id, cur AS current_gantry_id, nm AS name, gdir AS group_direction, road,
           CASE gdir WHEN 'S' THEN '南下' ELSE '北上' END AS direction_label,
           CAST(km AS DOUBLE) AS km, lat, lng FROM grp"""))
def groups_normalized(spark, sf_dir):
    """Section records with columns missing or blank: names and directions fall back."""
    raw = fixtures.station_groups(spark, sf_dir).withColumnRenamed("lat", "latitude").withColumn(
        "group_id", F.lit("")).drop("direction")
    return stations.normalize_groups(raw).select(
        "group_id", "current_gantry_id", "name", "group_direction", "road", "direction_label",
        "km", "lat", "lng")


@registered(with_views(EVENTS, GROUPS, select="SELECT station, group_id, nm AS name FROM mem"))
def station_lookup(spark, sf_dir):
    return lookup_of(spark, sf_dir).select("station", "group_id", "name")


@registered(with_views(EVENTS, GROUPS, select="""
    SELECT DISTINCT CASE road WHEN '03A' THEN '其他道路' ELSE road END AS road FROM grp"""))
def station_roads(spark, sf_dir):
    """Roads in order; a blank road goes under one name."""
    groups = groups_of(spark, sf_dir)
    return stations.roads(groups.withColumn("road", F.when(F.col("road") != "03A", F.col("road"))
                                            .otherwise(" ")))


@registered(with_views(EVENTS, GROUPS, select="""
    SELECT road, gdir AS direction, CAST(place AS INTEGER) AS place, group_id FROM ord"""))
def station_driving_order(spark, sf_dir):
    return stations.driving_order(groups_of(spark, sf_dir)).select(
        "road", F.col("group_direction").alias("direction"), "place", "group_id")


@registered(with_views(EVENTS, GROUPS, select="""
    , v AS (SELECT pos, bool_or(act AND pos <> 7 AND (pos = 9 OR fs <= '2024-01-10')
                                OR NOT act AND fs <= '2024-01-10' AND ls >= '2024-01-03') AS ok
            FROM hist GROUP BY pos)
    SELECT group_id, road, CAST(row_number() OVER (PARTITION BY road ORDER BY -km) AS INTEGER)
           AS place
    FROM grp JOIN v USING (pos) WHERE ok AND gdir = 'N'"""))
def active_stations(spark, sf_dir):
    """Northbound sections valid in some days, placed along their road."""
    return stations.active_sections(
        groups_of(spark, sf_dir), date(2024, 1, 3), date(2024, 1, 10), direction="N").select(
        "group_id", "road", "place")


@registered(with_views(EVENTS, GROUPS, select="""
    SELECT group_id FROM grp WHERE pos <> 7 AND pos <> 9"""))
def dated_stations(spark, sf_dir):
    """Sections with a version in the month; those without dates and not in use are out."""
    return stations.active_sections(
        groups_of(spark, sf_dir), date(2024, 1, 1), date(2024, 1, 31)).select("group_id")


_BUSY = """, busy AS (
    SELECT group_id AS start_id FROM ev JOIN hist ON hist.pos = k // 5
        AND hist.act = (k // 5 <> 4 OR t >= '2024-01-15') JOIN grp ON grp.pos = hist.pos
    GROUP BY 1)"""


def busy(spark, sf_dir):
    """Sections with traffic: the starts of requests."""
    rows = detections_of(spark, sf_dir).groupBy("GantryID").agg(F.sum("Volume").alias("v"))
    found = rows.join(lookup_of(spark, sf_dir), rows["GantryID"] == F.col("station"))
    return found.select(F.col("group_id").alias("start_id")).distinct()


@registered(with_views(EVENTS, GROUPS, select=_BUSY + """
    SELECT start_id, e.group_id AS end_id, e.road, CAST(e.place AS INTEGER) AS place,
           e.road <> s.road AS other_road
    FROM busy JOIN ord s ON s.group_id = start_id JOIN ord e ON e.gdir = s.gdir
    WHERE e.road <> s.road OR e.place > s.place"""))
def od_candidates(spark, sf_dir):
    """End sections offered for every start with traffic."""
    return stations.candidates(groups_of(spark, sf_dir), busy(spark, sf_dir))


@registered(with_views(EVENTS, GROUPS, select=_BUSY + """
    , valid AS (SELECT *, row_number() OVER (
                    PARTITION BY road, gdir
                    ORDER BY CASE WHEN gdir = 'N' THEN -km ELSE km END, nm, group_id) AS place
                FROM grp WHERE pos NOT IN (7, 9))
    SELECT start_id, e.group_id AS end_id, e.road, CAST(e.place AS INTEGER) AS place,
           e.road <> s.road AS other_road
    FROM busy JOIN valid s ON s.group_id = start_id JOIN valid e ON e.gdir = s.gdir
    WHERE e.road <> s.road OR e.place > s.place"""))
def od_candidates_dated(spark, sf_dir):
    """End sections for every start with traffic, of sections valid in the asked days only."""
    return stations.candidates(groups_of(spark, sf_dir), busy(spark, sf_dir),
                               (date(2024, 1, 5), date(2024, 1, 25)))


MOVED, OVER = "2024-01-15", "2024-01-20"


def moved_groups(spark, sf_dir):
    """Sections of which every station changes one: its own before ``MOVED``, one by road and
    direction from then on; that of 03A ends again after ``OVER``."""
    seen = fixtures.station_history(spark, sf_dir).select("station").distinct()
    version = lambda begin, end, active: F.array(F.struct(
        begin.cast("string").alias("first_seen"), end.cast("string").alias("last_seen"),
        active.alias("is_active")))
    alone = seen.select(
        F.concat(F.lit("Z_"), "station").alias("group_id"), F.col("station").alias("current_gantry_id"),
        F.array("station").alias("gantry_ids"), F.col("station").alias("display_name"),
        version(F.lit(None), F.lit(MOVED), F.lit(False)).alias("versions"))
    # a road has at most its stations, so the lists stay short
    road = F.substring("station", 1, 3)
    joined = seen.groupBy(F.concat(F.lit("R_"), road, F.right("station", F.lit(1))).alias("group_id")).agg(
        F.max("station").alias("current_gantry_id"), F.array_sort(F.collect_set("station")).alias("gantry_ids"))
    over = F.col("group_id").startswith("R_03A")
    return alone.unionByName(joined.select(
        "group_id", "current_gantry_id", "gantry_ids", F.col("group_id").alias("display_name"),
        version(F.lit(MOVED), F.when(over, F.lit(OVER)), ~over).alias("versions")))


@registered(with_views(DETECTIONS, select=f"""
    , d AS (SELECT g, substr(ti, 1, 10) AS day, vol FROM det),
      s AS (SELECT CASE WHEN day < '{MOVED}' THEN 'Z_' || g
                        WHEN substr(g, 1, 3) = '03A' AND day > '{OVER}' THEN 'RAW_' || g
                        ELSE 'R_' || substr(g, 1, 3) || right(g, 1) END AS group_id, * FROM d)
    SELECT group_id, CASE WHEN starts_with(group_id, 'R_') THEN group_id ELSE min(g) END AS name,
           count(DISTINCT g) AS stations, min(day) AS first_day, max(day) AS last_day,
           CAST(sum(vol) AS BIGINT) AS volume
    FROM s GROUP BY group_id"""))
def sections_in_time(spark, sf_dir):
    """Volume by the section each station was in on the day of its rows."""
    spans = stations.section_spans(stations.normalize_groups(moved_groups(spark, sf_dir)))
    rows = detections_of(spark, sf_dir).groupBy("GantryID", F.col("TimeInterval").alias("bucket")).agg(
        F.sum("Volume").alias("volume"))
    return stats.section_volume_in_time(rows, spans)


_PAIRS = """, pair AS (
    SELECT a.group_id AS start_id, b.group_id AS end_id, count(*) AS n
    FROM trp JOIN mem a ON a.station = g_o JOIN mem b ON b.station = g_d
    WHERE a.group_id <> b.group_id GROUP BY ALL)"""


def driven_pairs(spark, sf_dir):
    """Pairs of sections that trips lead between."""
    lookup = lookup_of(spark, sf_dir)
    at = lambda c, name: lookup.select(F.col("station").alias(c), F.col("group_id").alias(name))
    counted = trips_of(spark, sf_dir).groupBy("GantryID_O", "GantryID_D").agg(
        F.count(F.lit(1)).alias("n"))
    return (counted.join(at("GantryID_O", "start_id"), "GantryID_O")
            .join(at("GantryID_D", "end_id"), "GantryID_D").filter("start_id <> end_id")
            .groupBy("start_id", "end_id").agg(F.sum("n").alias("n")))


_CORRIDOR = """, cor AS (
    SELECT start_id, end_id, CAST(row_number() OVER (
               PARTITION BY start_id, end_id
               ORDER BY CASE WHEN g.gdir = 'N' THEN -g.km ELSE g.km END) AS INTEGER) AS step,
           g.group_id, CAST(g.km AS DOUBLE) AS km, g.lat, g.lng
    FROM pair JOIN grp a ON a.group_id = start_id JOIN grp b ON b.group_id = end_id
    JOIN grp g ON g.road = a.road AND g.gdir = a.gdir
    WHERE a.road = b.road AND g.lat IS NOT NULL
      AND g.km BETWEEN least(a.km, b.km) AND greatest(a.km, b.km))"""


@registered(with_views(TRIPS, GROUPS, select=_PAIRS + _CORRIDOR + " SELECT * FROM cor"))
def corridor(spark, sf_dir):
    """Sections between the ends of every driven pair."""
    return stations.corridor(groups_of(spark, sf_dir), driven_pairs(spark, sf_dir))


_WHOLE = """, whole AS (
    SELECT string_agg(st, ',' ORDER BY i) AS route FROM leg GROUP BY rid)"""


@registered(with_views(TRIPS, GROUPS, select=_WHOLE + """
    , routes AS (SELECT route, count(*) AS n FROM whole GROUP BY route),
      pts AS (SELECT route, idx, str_split(route, ',')[idx] AS station FROM (
                  SELECT route, unnest(range(1, len(str_split(route, ',')) + 1)) AS idx
                  FROM routes)),
      placed AS (SELECT route, idx, pts.station, lat, lng,
                        lag(lat) OVER (PARTITION BY route ORDER BY idx) AS lat0,
                        lag(lng) OVER (PARTITION BY route ORDER BY idx) AS lng0
                 FROM pts JOIN mem ON mem.station = pts.station WHERE lat IS NOT NULL)
    SELECT route, CAST(row_number() OVER (PARTITION BY route ORDER BY idx) AS INTEGER) AS step,
           station, lat, lng
    FROM placed WHERE lat0 IS NULL OR lat <> lat0 OR lng <> lng0"""))
def route_points(spark, sf_dir):
    """Coordinates along all whole routes."""
    driven = trips_of(spark, sf_dir).groupBy(F.array_join(
        station_ids(F.col("TripInformation")), ",").alias("route")).agg(
        F.count(F.lit(1)).alias("n"))
    return routes.route_points(driven, lookup_of(spark, sf_dir))


_ASKED = """, driven AS (
    SELECT a.group_id AS start_id, b.group_id AS end_id
    FROM trp JOIN mem a ON a.station = g_o JOIN mem b ON b.station = g_d
    WHERE a.group_id <> b.group_id),
  pair AS (
    SELECT DISTINCT start_id, end_id FROM (
        SELECT start_id, end_id FROM driven UNION ALL SELECT end_id, start_id FROM driven)
    WHERE start_id IN (SELECT group_id FROM grp WHERE lat IS NOT NULL)
      AND end_id IN (SELECT group_id FROM grp WHERE lat IS NOT NULL))"""


@registered(with_views(TRIPS, GROUPS, select=_ASKED + _CORRIDOR + _WHOLE + """
    , best AS (
        SELECT start_id, end_id, arg_min(route, {'m': -c, 'r': route}) AS route FROM (
            SELECT start_id, end_id, route, count(*) AS c
            FROM whole JOIN mem a ON a.station = split_part(route, ',', 1)
            JOIN mem b ON b.station = str_split(route, ',')[-1]
            JOIN pair ON start_id = a.group_id AND end_id = b.group_id
            GROUP BY ALL) GROUP BY ALL),
      pts AS (SELECT start_id, end_id, idx, str_split(route, ',')[idx] AS station FROM (
                  SELECT *, unnest(range(1, len(str_split(route, ',')) + 1)) AS idx FROM best)),
      obs AS (SELECT start_id, end_id,
                     CAST(row_number() OVER (PARTITION BY start_id, end_id ORDER BY idx) AS INTEGER)
                         AS step, lat, lng, 1 AS choice
              FROM pts JOIN mem USING (station) WHERE lat IS NOT NULL),
      ends AS (SELECT start_id, end_id, step, lat, lng, 3 AS choice
               FROM (SELECT start_id, end_id, 1 AS step, start_id AS spot FROM pair
                     UNION ALL SELECT start_id, end_id, 2, end_id FROM pair)
               JOIN grp ON grp.group_id = spot WHERE lat IS NOT NULL),
      opt AS (SELECT * FROM obs UNION ALL SELECT start_id, end_id, step, lat, lng, 2 FROM cor
              UNION ALL SELECT * FROM ends),
      pick AS (SELECT start_id, end_id, min(choice) AS choice FROM (
                   SELECT start_id, end_id, choice FROM opt GROUP BY ALL HAVING count(*) >= 2)
               GROUP BY ALL)
    SELECT start_id, end_id,
           CASE choice WHEN 1 THEN 'observed' WHEN 2 THEN 'corridor' ELSE 'ends' END AS source,
           CAST(step AS INTEGER) AS step, lat, lng
    FROM opt JOIN pick USING (start_id, end_id, choice)"""))
def route_fallback(spark, sf_dir):
    """What to draw for every driven pair and the way back: the route most driven, if any, else
    the corridor, else the two ends; nothing where an end has no coordinates."""
    lookup = lookup_of(spark, sf_dir)
    at = lambda c, name: lookup.select(F.col("station").alias(c), F.col("group_id").alias(name))
    driven = trips_of(spark, sf_dir).groupBy("GantryID_O", "GantryID_D", F.array_join(
        station_ids(F.col("TripInformation")), ",").alias("route")).agg(
        F.count(F.lit(1)).alias("n"))
    best = (driven.join(at("GantryID_O", "start_id"), "GantryID_O")
            .join(at("GantryID_D", "end_id"), "GantryID_D")
            .groupBy("start_id", "end_id", "route").agg(F.sum("n").alias("n"))
            .groupBy("start_id", "end_id").agg(
                F.min_by("route", F.struct(-F.col("n"), F.col("route"))).alias("route")))
    there = driven_pairs(spark, sf_dir).select("start_id", "end_id")
    back = there.select(F.col("end_id").alias("start_id"), F.col("start_id").alias("end_id"))
    pairs = there.unionByName(back).distinct().join(best, ["start_id", "end_id"], "left")
    return routes.drawn_route(pairs, groups_of(spark, sf_dir), lookup)


@registered(with_views(EVENTS, GROUPS, select="""
    , p AS (SELECT *, printf('%.5f,%.5f', lat, lng) AS spot FROM grp WHERE lat IS NOT NULL)
    SELECT spot, group_id, gdir AS group_direction,
           CAST(row_number() OVER (PARTITION BY spot ORDER BY gdir, group_id) AS INTEGER)
               AS position,
           count(*) OVER (PARTITION BY spot) AS size FROM p"""))
def colocated_stations(spark, sf_dir):
    return stations.co_located(groups_of(spark, sf_dir))


@registered(with_views(EVENTS, GROUPS, select="""
    SELECT group_id, lat, lng FROM grp WHERE lat IS NOT NULL"""))
def map_stations(spark, sf_dir):
    """Sections that can be shown: both coordinates finite, whatever their spelling."""
    raw = fixtures.station_groups(spark, sf_dir).select(
        "group_id", F.col("lat").cast("string").alias("y"),
        F.coalesce(F.col("lng").cast("string"), F.lit("east")).alias("lon"))
    shown = raw.select("group_id", stations.coordinate(raw, stations.LAT_NAMES).alias("lat"),
                       stations.coordinate(raw, stations.LNG_NAMES).alias("lng"))
    return shown.filter("lat is not null and lng is not null")


@registered(with_views(TRIPS, GROUPS, select="""
    , seen AS (
        SELECT a.cur AS start_gantry, b.cur AS end_gantry, a.group_id AS start_group,
               b.group_id AS end_group, count(*) AS n
        FROM trp JOIN mem a ON a.station = g_d JOIN mem b ON b.station = g_o GROUP BY ALL
        UNION ALL
        SELECT a.cur, b.cur, a.group_id, b.group_id, count(*)
        FROM trp JOIN mem a ON a.station = g_o JOIN mem b ON b.station = g_d GROUP BY ALL)
    SELECT start_gantry, end_gantry, n, CASE
        WHEN start_group = end_group THEN 'same section'
        WHEN right(start_gantry, 1) <> right(end_gantry, 1) THEN 'opposite direction'
        WHEN substr(start_gantry, 1, 3) = substr(end_gantry, 1, 3)
             AND CASE WHEN right(start_gantry, 1) = 'N'
                      THEN substr(start_gantry, 4, 4) <= substr(end_gantry, 4, 4)
                      ELSE substr(start_gantry, 4, 4) >= substr(end_gantry, 4, 4) END
        THEN 'against the way' ELSE 'ok' END AS verdict
    FROM seen"""))
def od_validity(spark, sf_dir):
    """Observed pairs both ways round: which of them an OD request accepts."""
    lookup = lookup_of(spark, sf_dir)
    at = lambda c, name: lookup.select(
        F.col("station").alias(c), F.col("group_id").alias(f"{name}_group"),
        F.col("current_gantry_id").alias(f"{name}_gantry"))
    counted = trips_of(spark, sf_dir).groupBy("GantryID_O", "GantryID_D").agg(
        F.count(F.lit(1)).alias("n"))
    keys = ["start_gantry", "end_gantry", "start_group", "end_group"]
    ways = [counted.join(at("GantryID_O", a), "GantryID_O").join(at("GantryID_D", b), "GantryID_D")
            .groupBy(*keys).agg(F.sum("n").alias("n"))
            for a, b in (("end", "start"), ("start", "end"))]
    return stations.pair_validity(ways[0].unionByName(ways[1])).select(
        "start_gantry", "end_gantry", "n", "verdict")


@registered(with_views(TRIPS, GROUPS, select="""
    , seen AS (SELECT b.group_id AS first_id, a.group_id AS second_id
               FROM trp JOIN mem a ON a.station = g_o JOIN mem b ON b.station = g_d GROUP BY ALL),
      j AS (SELECT first_id, second_id, CASE WHEN first_id = second_id THEN 'same'
                   WHEN a.gdir <> b.gdir THEN 'opposite'
                   WHEN a.road = b.road AND b.place < a.place THEN 'swapped' ELSE 'kept' END AS state
            FROM seen JOIN ord a ON a.group_id = first_id JOIN ord b ON b.group_id = second_id)
    SELECT *, CASE state WHEN 'swapped' THEN second_id ELSE first_id END AS start_id,
           CASE state WHEN 'swapped' THEN first_id ELSE second_id END AS end_id FROM j"""))
def od_oriented(spark, sf_dir):
    """Observed pairs named the wrong way round, put in driving direction."""
    lookup = lookup_of(spark, sf_dir)
    at = lambda c, name: lookup.select(F.col("station").alias(c), F.col("group_id").alias(name))
    ends = trips_of(spark, sf_dir).select("GantryID_O", "GantryID_D").distinct()
    pairs = (ends.join(at("GantryID_D", "first_id"), "GantryID_D")
             .join(at("GantryID_O", "second_id"), "GantryID_O")
             .select("first_id", "second_id").distinct())
    return stations.oriented(groups_of(spark, sf_dir), pairs)
