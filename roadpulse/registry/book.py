"""The book of registered queries and the shared SQL views of the fixtures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadpulse.fixtures import EVENT_VEHICLE, RENUMBERED

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def registered(sql: str | None = None):
    """Register a query under its function name, with the SQL that must agree."""
    def note(query):
        QUERIES[query.__name__] = query
        if sql is not None:
            SQL[query.__name__] = sql
        return query
    return note


def station_sql(position: str, time: str) -> str:
    return f"""CASE WHEN {position} = 4 AND {time} < '{RENUMBERED}' THEN '01F0459N' ELSE
        CASE WHEN {position} < 10 THEN '01F' WHEN {position} < 16 THEN '03F'
             WHEN {position} < 18 THEN '01H' ELSE '03A' END
        || lpad(CAST({position} * 115 AS VARCHAR), 4, '0')
        || CASE WHEN {position} % 2 = 0 THEN 'N' ELSE 'S' END END"""


_VEHICLES = " ".join(f"WHEN '{name}' THEN {code}" for name, code in EVENT_VEHICLE.items())

EVENTS = f"""ev AS (
    SELECT row_number() OVER () AS rid, event_type, date_trunc('second', ts) AS ts0,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS t,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           CAST(floor(value) AS INTEGER) AS amount,
           CASE event_type {_VEHICLES} END AS vt
    FROM events)"""

DETECTIONS = EVENTS + f""", det AS (
    SELECT substr(t, 1, 14) || lpad(CAST(CAST(substr(t, 15, 2) AS INTEGER) // 5 * 5 AS VARCHAR),
                                    2, '0') AS ti,
           g, right(g, 1) AS dir, vt, amount AS vol
    FROM (SELECT *, {station_sql("(k // 5)", "t")} AS g FROM ev))"""

TRIPS = EVENTS + f""", leg0 AS (
    SELECT rid, vt, t, k, i, k // 5 + (CASE WHEN (k // 5) % 2 = 0 THEN -2 ELSE 2 END) * i AS pos,
           strftime(ts0 + to_seconds(i * (60 + amount * 5)), '%Y-%m-%d %H:%M:%S') AS lt
    FROM (SELECT *, unnest(range(0, k % 5 + 1)) AS i FROM ev)),
  leg AS (SELECT *, {station_sql("pos", "lt")} AS st FROM leg0 WHERE pos BETWEEN 0 AND 19),
  trp AS (
    SELECT any_value(vt) AS vt, any_value(t) AS time_o, arg_min(st, i) AS g_o,
           arg_max(lt, i) AS time_d, arg_max(st, i) AS g_d, (count(*) - 1) * 23.0::DOUBLE AS len,
           CASE WHEN count(*) = any_value(k) % 5 + 1 THEN 'Y' ELSE 'N' END AS fin,
           string_agg(lt || '+' || st, '; ' ORDER BY i) AS path
    FROM leg GROUP BY rid)"""

HISTORY = f"""hist AS (
    SELECT pos, st, min(substr(t, 1, 10)) AS fs, max(substr(t, 1, 10)) AS ls,
           st <> '01F0459N' AS act
    FROM (SELECT k // 5 AS pos, t, {station_sql("(k // 5)", "t")} AS st FROM ev)
    GROUP BY pos, st)"""

SECTIONS = """grp AS (
    SELECT pos, 'G_' || cur AS group_id, cur, 'Section ' || lpad(CAST(pos AS VARCHAR), 2, '0') AS nm,
           right(cur, 1) AS gdir, substr(cur, 1, 3) AS road,
           CAST(substr(cur, 4, 4) AS INTEGER) / 10.0 AS km,
           CASE WHEN pos <> 18 THEN CAST(25.0 - (pos // 2) * 0.125 AS DOUBLE) END AS lat,
           CASE WHEN pos <> 18 THEN CAST(121.5 - (pos // 2) * 0.0625 AS DOUBLE) END AS lng
    FROM (SELECT pos, arg_max(st, fs) AS cur FROM hist GROUP BY pos)),
  mem AS (SELECT hist.st AS station, grp.* FROM hist JOIN grp USING (pos)),
  ord AS (SELECT *, row_number() OVER (
              PARTITION BY road, gdir
              ORDER BY CASE WHEN gdir = 'N' THEN -km ELSE km END, nm, group_id) AS place
          FROM grp)"""

DIMENSION = """dim AS (
    SELECT st AS id, act, CASE WHEN pos = 4 AND act THEN '01F0459N' END AS old_id,
           CASE WHEN pos = 4 AND NOT act THEN '01F0460N' END AS new_id FROM hist
    UNION ALL
    SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0'),
           s_suppkey % 4 >= 2 AND (s_suppkey // 4) % 3 <> 0,
           CASE WHEN s_suppkey % 4 <> 0 THEN 'S' || lpad(CAST(s_suppkey - 1 AS VARCHAR), 9, '0') END,
           NULL FROM supplier)"""

LINKED = DIMENSION + """, half AS (
    SELECT id, old_id AS other FROM dim WHERE old_id IS NOT NULL
    UNION SELECT id, new_id FROM dim WHERE new_id IS NOT NULL),
  edge AS (SELECT id, other FROM half UNION SELECT other, id FROM half),
  reach AS (SELECT id, id AS r FROM edge
            UNION SELECT reach.id, edge.other FROM reach JOIN edge ON reach.r = edge.id),
  comp AS (SELECT id, min(r) AS component FROM reach GROUP BY id),
  alias AS (SELECT comp.id, comp.component, c.canonical, c.members FROM comp JOIN (
      SELECT component, coalesce(min(CASE WHEN dim.act THEN comp.id END), max(comp.id)) AS canonical,
             count(DISTINCT comp.id) AS members
      FROM comp LEFT JOIN dim ON dim.id = comp.id GROUP BY component) c USING (component))"""

LISTING = """files AS (
    SELECT name, sum(amount) AS length FROM (
        SELECT 'TDCS_M03A_' || strftime(ts0, '%Y%m%d_%H')
               || lpad(CAST(minute(ts0) // 5 * 5 AS VARCHAR), 2, '0') || '00.csv' AS name, amount
        FROM ev
        UNION ALL
        SELECT 'TDCS_M06A_' || strftime(ts0, '%Y%m%d_%H') || '0000.csv', amount FROM ev)
    GROUP BY name),
  landed AS (SELECT name, substr(name, 6, 4) AS dtype,
                    strptime(substr(name, 11, 8), '%Y%m%d')::DATE AS day
             FROM files WHERE length > 0)"""


GROUPS = HISTORY + ", " + SECTIONS
ALIAS = HISTORY + ", " + LINKED


def grid_sql(first: str, last: str) -> str:
    """Expected files between two SQL dates."""
    return f"""grid AS (
    SELECT dtype, day, 'TDCS_' || dtype || '_' || strftime(day, '%Y%m%d') || '_'
           || lpad(CAST(m // 60 AS VARCHAR), 2, '0') || lpad(CAST(m % 60 AS VARCHAR), 2, '0')
           || '00.csv' AS name
    FROM (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 DAY))::DATE AS day),
         (VALUES ('M06A', 60), ('M03A', 5)) AS types(dtype, step),
         (SELECT unnest(range(0, 1440, 5)) AS m)
    WHERE m % step = 0)"""


def with_views(*views: str, select: str) -> str:
    return "WITH RECURSIVE " + ", ".join(views) + " " + select
