"""Column-function queries: dates, labels, numbers, durations."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse import fixtures, schemas
from roadpulse.functions import station_ids, text
from roadpulse.functions import timeparts as tp
from roadpulse.registry.book import DETECTIONS, EVENTS, TRIPS, registered, with_views
from roadpulse.registry.facts import detections_of, trips_of


@registered("""
    SELECT DISTINCT strftime(d, '%Y-%m-%d') AS day,
           strftime(d - CAST(dayofweek(d) AS INTEGER), '%Y-%m-%d') AS week_first,
           strftime(d + (6 - CAST(dayofweek(d) AS INTEGER)), '%Y-%m-%d') AS week_last,
           strftime(date_trunc('month', d), '%Y-%m-%d') AS month_first,
           strftime(last_day(d), '%Y-%m-%d') AS month_last
    FROM (SELECT o_orderdate::DATE AS d FROM orders)""")
def week_month_ranges(spark, sf_dir):
    """Sunday-to-Saturday week and month around every order day."""
    day = F.col("day")
    days = fixtures.table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("day")).distinct()
    show = lambda d: F.date_format(d, "yyyy-MM-dd")
    return days.select(show(day).alias("day"), show(tp.week_start(day)).alias("week_first"),
                       show(tp.week_end(day)).alias("week_last"),
                       show(tp.month_start(day)).alias("month_first"),
                       show(tp.month_end(day)).alias("month_last"))


@registered(with_views(EVENTS, select="""
    SELECT rid_text, CASE WHEN event_type = 'view' THEN k::DOUBLE
           WHEN event_type = 'click' THEN k * 60 + amount % 60 + 30 / 60.0::DOUBLE
           WHEN event_type = 'purchase' THEN k + (amount % 60) / 60.0::DOUBLE
           WHEN event_type = 'signup' THEN k + 0.25::DOUBLE END AS minutes
    FROM (SELECT *, event_type || ' ' || k || ' ' || amount AS rid_text FROM ev) GROUP BY ALL"""))
def duration_parse(spark, sf_dir):
    """Minutes out of numbers, H:MM:SS, M:SS and junk."""
    ev = fixtures.events(spark, sf_dir, None)
    kind, k = F.col("event_type"), F.col("k").cast("string")
    minute = F.lpad((F.col("amount") % 60).cast("string"), 2, "0")
    written = (F.when(kind == "view", k).when(kind == "click", F.concat(k, F.lit(":"), minute,
                                                                       F.lit(":30")))
               .when(kind == "purchase", F.concat(k, F.lit(":"), minute))
               .when(kind == "signup", F.concat(F.lit(" "), k, F.lit(".25 ")))
               .otherwise(F.concat(k, F.lit(" min"))))
    return ev.select(
        F.concat_ws(" ", "event_type", "k", "amount").alias("rid_text"),
        text.duration_minutes(written).alias("minutes")).distinct()


@registered("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE floor(o_totalprice) END::DOUBLE
           AS number FROM orders""")
def number_parse(spark, sf_dir):
    """Numbers with thousands commas; a text that is none counts as 0."""
    price = F.format_number(F.floor("o_totalprice"), 0)
    written = F.when(F.col("o_orderstatus") == "P", F.concat(price, F.lit(" dollars"))).otherwise(
        F.concat(F.lit(" "), price))
    return fixtures.table(spark, sf_dir, "orders").select(
        "o_orderkey", text.number_value(written).alias("number"))


@registered(with_views(DETECTIONS, select="""
    SELECT g AS station, CAST(substr(g, 4, 4) AS INTEGER) / 10.0::DOUBLE AS km,
           substr(g, 1, 3) AS road, right(g, 1) AS direction, count(*) AS n
    FROM det GROUP BY ALL"""))
def station_km(spark, sf_dir):
    station = F.col("station")
    seen = detections_of(spark, sf_dir).groupBy(F.col("GantryID").alias("station")).agg(
        F.count(F.lit(1)).alias("n"))
    return seen.select("station", station_ids.km_post(station).alias("km"),
                       station_ids.road_code(station).alias("road"),
                       station_ids.direction_suffix(station).alias("direction"), "n")


@registered(with_views(DETECTIONS, select="""
    , x AS (SELECT vt AS code, dir, vol FROM det UNION ALL SELECT vt + 1000, 'X', vol FROM det)
    SELECT CAST(code AS INTEGER) AS code, dir AS direction,
           CASE code WHEN 31 THEN '小客車' WHEN 32 THEN '小貨車' WHEN 41 THEN '大客車'
                WHEN 42 THEN '大貨車' WHEN 5 THEN '聯結車' ELSE '其他車種' END AS vehicle_label,
           CASE dir WHEN 'S' THEN '南下' ELSE '北上' END AS road_label,
           CASE dir WHEN 'N' THEN '北向（N）' WHEN 'S' THEN '南向（S）' ELSE '全部方向' END
               AS query_label, CAST(sum(vol) AS BIGINT) AS volume
    FROM x GROUP BY ALL"""))
def labels(spark, sf_dir):
    """Vehicle and direction labels, codes outside the domain included."""
    rows = detections_of(spark, sf_dir).select(
        F.col("VehicleType").alias("code"), F.col("Direction").alias("direction"), "Volume")
    both = rows.unionByName(rows.select((F.col("code") + 1000).alias("code"),
                                        F.lit("X").alias("direction"), "Volume"))
    return both.groupBy("code", "direction").agg(F.sum("Volume").alias("volume")).select(
        "code", "direction", schemas.vehicle_label(F.col("code")).alias("vehicle_label"),
        schemas.road_direction_label(F.col("direction")).alias("road_label"),
        schemas.query_direction_label(F.col("direction")).alias("query_label"), "volume")


@registered(with_views(TRIPS, select="""
    SELECT time_o AS "time", substr(time_o, 1, 10) AS day_part,
           replace(time_o, '-', '/') AS query_shown, replace(substr(time_o, 1, 16), '-', '/') AS shown,
           substr(time_o, 1, 13) || ':00' AS hour, substr(time_o, 1, 14)
               || lpad(CAST(CAST(substr(time_o, 15, 2) AS INTEGER) // 15 * 15 AS VARCHAR), 2, '0')
               AS quarter, substr(time_o, 1, 7) AS month,
           (epoch(time_d::TIMESTAMP) - epoch(time_o::TIMESTAMP))::DOUBLE / 60 AS minutes
    FROM trp"""))
def text_times(spark, sf_dir):
    """Buckets, displays and differences of text times."""
    rows = trips_of(spark, sf_dir)
    time = F.col("DetectionTime_O")
    with_t = F.translate(time, " ", "T")
    return rows.select(
        time.alias("time"), tp.date_part(F.concat(F.lit("at "), with_t)).alias("day_part"),
        tp.query_time_display(time).alias("query_shown"),
        tp.timestamp_display(with_t).alias("shown"), tp.hour_of(time).alias("hour"),
        tp.slot_of(time, 15).alias("quarter"), tp.month_of(time).alias("month"),
        tp.minutes_between(time, F.col("DetectionTime_D")).alias("minutes"))


@registered("""
    WITH d AS (SELECT o_orderdate::DATE AS d, CASE o_orderstatus WHEN 'F' THEN 'daily'
                      WHEN 'O' THEN 'weekly' ELSE 'monthly' END AS p FROM orders),
         r AS (SELECT DISTINCT p, d AS a, CASE p WHEN 'daily' THEN d WHEN 'weekly' THEN d + 6
                      ELSE last_day(d) END AS b FROM d)
    SELECT p AS period, strftime(a, '%Y-%m-%d') AS first,
           CASE p WHEN 'daily' THEN '日流量' WHEN 'weekly' THEN '週流量' ELSE '月流量' END || '｜'
           || strftime(a, '%Y/%m/%d')
           || CASE WHEN a = b THEN '' ELSE ' ～ ' || strftime(b, '%Y/%m/%d') END AS label
    FROM r""")
def period_labels(spark, sf_dir):
    """Titles of statistics periods that begin on each order day."""
    status, day = F.col("o_orderstatus"), F.col("o_orderdate").cast("date")
    period = F.when(status == "F", "daily").when(status == "O", "weekly").otherwise("monthly")
    rows = fixtures.table(spark, sf_dir, "orders").select(
        period.alias("period"), day.alias("a")).distinct()
    last = F.when(F.col("period") == "daily", F.col("a")).when(
        F.col("period") == "weekly", F.date_add("a", 6)).otherwise(F.last_day("a"))
    return rows.select("period", F.date_format("a", "yyyy-MM-dd").alias("first"),
                       tp.period_label(F.col("period"), F.col("a"), last).alias("label"))


@registered("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS good, '' AS bad,
           format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS grouped,
           printf('%02d:%02d:%05.2f', s // 3600, s // 60 % 60, (s % 60)::DOUBLE) AS hms
    FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) % 90000 AS s FROM orders)""")
def strict_dates_and_formats(spark, sf_dir):
    """Strict date parsing, thousands grouping, hours-minutes-seconds."""
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    whole = F.floor("o_totalprice")
    shown = F.date_format(tp.strict_date(F.concat(F.lit(" "), day)), "yyyy-MM-dd")
    broken = tp.strict_date(F.concat(F.substring(day, 1, 8), F.lit("41")))
    return fixtures.table(spark, sf_dir, "orders").select(
        "o_orderkey", shown.alias("good"),
        F.coalesce(F.date_format(broken, "yyyy-MM-dd"), F.lit("")).alias("bad"),
        text.grouped(whole).alias("grouped"), text.hms(whole % 90000).alias("hms"))


@registered("""
    SELECT o_orderkey, format('{:,}', CAST(trunc(x) AS BIGINT)) || right(printf('%.1f', x), 2) || '%' AS share
    FROM (SELECT o_orderkey, round((CAST(floor(o_totalprice) AS BIGINT) % 100000) / 8.0::DOUBLE, 1) AS x
          FROM orders)""")
def percent_display(spark, sf_dir):
    whole = F.floor("o_totalprice") % 100000
    return fixtures.table(spark, sf_dir, "orders").select(
        "o_orderkey", text.percent_text(whole / F.lit(8.0)).alias("share"))
