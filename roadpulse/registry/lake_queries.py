"""Queries that write and read back: CSV, archives, the lake, streams."""

from __future__ import annotations

import io
import tarfile
from datetime import date

import pandas as pd
from pyspark.sql import functions as F

from roadpulse import fixtures
from roadpulse.functions.timeparts import TimeRange, day_of
from roadpulse.operators import quality, stats
from roadpulse.plans import convert
from roadpulse.registry.book import DETECTIONS, EVENTS, TRIPS, registered, with_views
from roadpulse.schemas import file_month, retype, with_day
from roadpulse.session import fresh_dir
from roadpulse.sources import lake, landing
from roadpulse.streaming import jobs

_BY_DAY = """SELECT substr(ti, 1, 10) AS day, count(*) AS row_count,
    CAST(sum(vol) AS BIGINT) AS volume FROM det GROUP BY 1"""


def by_day(rows):
    return rows.groupBy(day_of(F.col("TimeInterval")).alias("day")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("Volume").alias("volume"))


@registered(with_views(DETECTIONS, select="""
    SELECT ti AS "TimeInterval", g AS "GantryID", dir AS "Direction", vt AS "VehicleType",
           vol AS "Volume" FROM det"""))
def csv_roundtrip(spark, sf_dir):
    """Headerless CSV written and read under the fixed schema."""
    path = fresh_dir(spark, "csv")
    fixtures.detections(spark, sf_dir).write.csv(path)
    return landing.csv_slots(spark, path, "M03A")


@registered(with_views(TRIPS, select="""
    SELECT vt AS "VehicleType", time_o AS "DetectionTime_O", g_o AS "GantryID_O",
           time_d AS "DetectionTime_D", g_d AS "GantryID_D", len AS "TripLength", fin AS "TripEnd",
           path AS "TripInformation" FROM trp"""))
def csv_trips(spark, sf_dir):
    path = fresh_dir(spark, "csv")
    fixtures.trips(spark, sf_dir).write.csv(path)
    return landing.csv_slots(spark, path, "M06A")


@registered(with_views(DETECTIONS, select="""
    SELECT ti || ':00' AS "time", g AS gantry_id, dir AS direction, CAST(vt AS VARCHAR)
           AS vehicle_type, CAST(vol AS BIGINT) AS traffic_volume
    FROM det WHERE vt IN (31, 32, 41)"""))
def strict_csv(spark, sf_dir):
    """Lines with a bad volume (42) or a missing field (5) are left out, blanks trimmed."""
    path = fresh_dir(spark, "lines")
    v = F.col("VehicleType")
    (fixtures.detections(spark, sf_dir).select(F.concat_ws(
        ",", F.concat(F.lit(" "), "TimeInterval"), F.concat("GantryID", F.lit(" ")), "Direction",
        v.cast("string"), F.when(v == 5, None).when(v == 42, "many").otherwise(
            F.col("Volume").cast("string")))).write.text(path))
    return landing.strict_csv(spark, path)


def packed(rows):
    """Archives out of CSV lines: every Arrow batch of a task becomes one tar.gz."""
    def pack(batches):
        for number, batch in enumerate(batches):
            buffer = io.BytesIO()
            with tarfile.open(fileobj=buffer, mode="w:gz") as tar:
                for at in range(0, len(batch), 500):
                    data = "\n".join(batch["line"].iloc[at:at + 500]).encode()
                    member = tarfile.TarInfo(f"deep/er/slot_{at}.csv")
                    member.size = len(data)
                    tar.addfile(member, io.BytesIO(data))
            yield pd.DataFrame({"path": [f"batch_{number}"], "content": [buffer.getvalue()]})

    return rows.mapInPandas(pack, "path string, content binary")


@registered(with_views(DETECTIONS, select="""
    SELECT ti AS "TimeInterval", g AS "GantryID", dir AS "Direction", vt AS "VehicleType",
           vol AS "Volume" FROM det"""))
def archive_scan(spark, sf_dir):
    """Detections packed into archives and read back out of their members."""
    lines = fixtures.detections(spark, sf_dir).select(F.to_csv(F.struct("*")).alias("line"))
    return landing.parsed_lines(landing.archive_lines(packed(lines)), "M03A")


@registered(with_views(DETECTIONS, select=_BY_DAY))
def lake_publish(spark, sf_dir):
    """Verified publish into the lake, then a pruned scan of the month."""
    root = fresh_dir(spark, "lake")
    lake.publish(fixtures.detections(spark, sf_dir), "M03A", root)
    span = TimeRange.days("2024-01-01", "2024-01-31")
    return by_day(lake.scan(spark, root, "M03A", span))


@registered(with_views(TRIPS, select="""
    SELECT substr(time_o, 1, 4) AS year, substr(time_o, 6, 2) AS month, count(*) AS src_count,
           count(*) AS dst_count, 'OK' AS status FROM trp GROUP BY ALL"""))
def publish_check(spark, sf_dir):
    """The count check a publish returns."""
    return lake.publish(fixtures.trips(spark, sf_dir), "M06A", fresh_dir(spark, "lake"), files=4)


@registered(with_views(TRIPS, select="""
    SELECT vt AS "VehicleType", count(*) AS src_count,
           count(*) FILTER (fin = 'Y' OR vt <> 31) AS dst_count,
           CASE WHEN count(*) = count(*) FILTER (fin = 'Y' OR vt <> 31) THEN 'OK'
                ELSE 'MISMATCH' END AS status
    FROM trp GROUP BY vt"""))
def count_check(spark, sf_dir):
    """Source against a target that lost rows of one key."""
    whole = fixtures.trips(spark, sf_dir)
    return quality.count_check(whole, whole.filter("TripEnd = 'Y' or VehicleType <> 31"),
                               ["VehicleType"])


@registered(with_views(DETECTIONS, select=_BY_DAY))
def lake_compacted(spark, sf_dir):
    """Months published in parts, then rewritten to files as many as their bytes ask for."""
    root = fresh_dir(spark, "lake")
    lake.publish(fixtures.detections(spark, sf_dir), "M03A", root)
    lake.rewrite(spark, root, "M03A", target_bytes=64 * 1024, force=True)
    return by_day(lake.tree(spark, root, "M03A"))


_LANDED_DAYS = """
    , f AS (SELECT CASE k WHEN 99 THEN 'never' ELSE substr(t, 1, 10) END AS day, amount,
                   strftime(ts0 - INTERVAL 30 MINUTE, '%Y%m%d') AS file_day, rid
            FROM ev),
      s AS (SELECT file_day, count(DISTINCT rid % CASE WHEN right(file_day, 1) IN ('0', '5')
                                                 THEN 288 ELSE 24 END) AS files
            FROM (SELECT f.*, e.event_id AS rid FROM (SELECT row_number() OVER () AS n, * FROM events) e
                  JOIN (SELECT row_number() OVER () AS n, * EXCLUDE rid FROM f) f USING (n)) GROUP BY 1)"""


@registered(with_views(EVENTS, select=_LANDED_DAYS + """
    SELECT stage, day, count(*) AS row_count, CAST(sum(amount) AS BIGINT) AS volume
    FROM f JOIN s USING (file_day), (VALUES ('complete'), ('forced')) AS stages(stage)
    WHERE stage = 'forced' OR files = 288 GROUP BY 1, 2"""))
def convert_days(spark, sf_dir):
    """Landed files to the lake: complete days, each once in two runs; then all days by force."""
    landed, root = fresh_dir(spark, "slots"), fresh_dir(spark, "lake")
    fixtures.land(fixtures.landing_days(spark, sf_dir), landed)
    days = date(2023, 12, 31), date(2024, 2, 1)
    parts = []
    for stage, runs in (("complete", (False, False)), ("forced", (True,))):
        for force in runs:
            convert.convert_days(spark, landed, root, *days, force=force)
        rows = lake.tree(spark, root, "M03A")
        parts.append(rows.groupBy(F.when(F.col("TimeInterval") == "never", "never").otherwise(
            day_of(F.col("TimeInterval"))).alias("day")).agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("Volume").alias("volume")).select(
            F.lit(stage).alias("stage"), "*"))
    return parts[0].unionByName(parts[1])


@registered(with_views(TRIPS, select="""
    SELECT substr(time_o, 1, 4) AS year, substr(time_o, 6, 2) AS month, count(*) AS n, sum(len) AS km,
           count(DISTINCT substr(time_o, 1, 13)) AS raw_count FROM trp GROUP BY 1, 2"""))
def convert_months(spark, sf_dir):
    """Hourly files that land in two parts, taken as they come, and their stamps."""
    landed, root, marks = (fresh_dir(spark, label) for label in ("hours", "lake", "stamps"))
    lines = fixtures.landing_hours(spark, sf_dir)
    early = F.substring("name", 20, 2) < "12"
    for part in (early, ~early):
        fixtures.land(lines.filter(part), landed)
        convert.convert_months(spark, landed, root, marks)
    convert.convert_months(spark, landed, root, marks)
    rows = lake.tree(spark, root, "M06A").groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("TripLength").alias("km"))
    return rows.join(lake.stamps(spark, marks).drop("dtype"), ["year", "month"])


@registered("""
    SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
           count(*) AS n, CAST(sum(CASE WHEN month(o_orderdate) = 2 AND year(o_orderdate) = 1996
                                   THEN 2 ELSE 1 END) AS BIGINT) AS version
    FROM orders GROUP BY 1, 2""")
def dynamic_overwrite(spark, sf_dir):
    """One month written again: it is replaced, all others stay."""
    root = fresh_dir(spark, "months")
    rows = fixtures.landed_orders(spark, sf_dir).select(
        F.col("year").cast("int"), F.col("month").cast("int"), "name")
    lake.write_months(rows.withColumn("version", F.lit(1)), root)
    lake.write_months(rows.filter("year = 1996 and month = 2").withColumn("version", F.lit(2)),
                      root)
    stored = spark.read.schema("name string, version int, year string, month string").parquet(root)
    return stored.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"),
                                               F.sum("version").alias("version"))


@registered(with_views(TRIPS, select="""
    SELECT vt * 2 AS vehicle, m AS month, count(*) AS n, sum(len) AS km
    FROM trp, (VALUES ('01'), ('02')) AS months(m) GROUP BY ALL"""))
def retyped_union(spark, sf_dir):
    """An all-text drop and a typed one, each read by itself, as one typed fact."""
    typed, text = fresh_dir(spark, "typed"), fresh_dir(spark, "text")
    rows = fixtures.trips(spark, sf_dir).withColumn("year", F.lit("2024"))
    lake.write_months(rows.withColumn("month", F.lit("01")), typed)
    lake.write_months(rows.select(*[F.col(c).cast("string") for c in rows.columns],
                                  F.lit("02").alias("month")), text)
    both = lake.retype_months(spark, [typed, text], "M06A")
    return both.groupBy((F.col("VehicleType") * 2).alias("vehicle"), "month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("TripLength").alias("km"))


@registered(with_views(DETECTIONS, select=_BY_DAY))
def mixed_layout(spark, sf_dir):
    """Days up to the 15th stored by day, later ones by month, read as one."""
    root = fresh_dir(spark, "mixed")
    rows = file_month(fixtures.detections(spark, sf_dir), "TimeInterval").withColumn(
        "day", F.substring("TimeInterval", 9, 2))
    rows.filter("day <= '15'").write.partitionBy("year", "month", "day").parquet(root)
    rows.filter("day > '15'").drop("day").write.mode("append").partitionBy(
        "year", "month").parquet(root)
    return by_day(lake.mixed_layout(spark, root, "M03A"))


@registered(with_views(TRIPS, select="""
    SELECT substr(time_o, 9, 2) AS day, substr(time_o, 1, 4) AS year, substr(time_o, 6, 2) AS month,
           count(*) AS n, sum(len) AS km FROM trp GROUP BY ALL"""))
def table_overwrite(spark, sf_dir):
    """A catalog table with ``day`` as a column, its month overwritten twice."""
    location = fresh_dir(spark, "table")
    name = "trips_" + location.rsplit("-", 1)[-1]
    lake.create_table(spark, name, "M06A", location)
    rows = with_day(file_month(fixtures.trips(spark, sf_dir), "DetectionTime_O"),
                    "DetectionTime_O")
    for _ in range(2):
        lake.overwrite_month(rows, name, "2024", "01")
    return spark.table(name).groupBy("day", "year", "month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("TripLength").alias("km"))


@registered("""
    SELECT 'M06A' AS dtype, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
           CAST(count(*) + any_value(CASE WHEN year(o_orderdate) = 1997 THEN 1000 ELSE 0 END)
                AS BIGINT) AS raw_count
    FROM orders GROUP BY 2, 3""")
def manifest_stamps(spark, sf_dir):
    """Stamped file counts; the months of one year are stamped again."""
    path = fresh_dir(spark, "stamps")
    counts = fixtures.landed_orders(spark, sf_dir).groupBy("dtype", "year", "month").agg(
        F.count(F.lit(1)).alias("raw_count"))
    lake.stamp(counts, path)
    lake.stamp(counts.filter("year = '1997'").withColumn("raw_count", F.col("raw_count") + 1000),
               path)
    return lake.stamps(spark, path).select("dtype", "year", "month", "raw_count")


@registered("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           arg_max(CASE o_orderstatus WHEN 'F' THEN 'OK' WHEN 'O' THEN 'MISMATCH' ELSE 'ERROR' END,
                   strftime(o_orderdate, '%Y-%m-%d') || 'T'
                   || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS status
    FROM orders GROUP BY 1, 2""")
def state_log(spark, sf_dir):
    """Job records appended as JSON lines, broken ones in between, last one per month."""
    path = fresh_dir(spark, "state")
    landing.append_state(fixtures.job_state(spark, sf_dir), path)
    fixtures.table(spark, sf_dir, "nation").select(
        F.concat(F.lit('{"year": '), "n_name").alias("value")).write.mode("append").text(path)
    return quality.latest_state(landing.state_log(spark, path))


@registered("""
    SELECT '{"o_orderkey":' || o_orderkey || ',"day":"' || strftime(o_orderdate, '%Y-%m-%d')
           || '","at":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '","status":"'
           || o_orderstatus || '"}' AS json
    FROM orders""")
def json_rows(spark, sf_dir):
    return landing.json_rows(fixtures.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderdate").alias("at"), F.col("o_orderstatus").alias("status")))


@registered(with_views(DETECTIONS, select="""
    SELECT CAST(count(DISTINCT substr(ti, 1, 10)) AS BIGINT) AS days,
           CAST(sum(vol) AS BIGINT) AS volume, count(*) AS row_count FROM det"""))
def listed_lake(spark, sf_dir):
    """Days known from the file listing alone, totals from the lake it lists."""
    root = fresh_dir(spark, "listed")
    rows = fixtures.detections(spark, sf_dir).withColumn("day", F.substring("TimeInterval", 1, 10))
    rows.write.partitionBy("day").parquet(root)
    files = landing.listed_partitions(landing.listing(spark, root), ("day",))
    days = files.filter("day is not null").select("day").distinct().agg(
        F.count("day").alias("n")).scalar()
    return spark.read.parquet(root).agg(F.sum("Volume").alias("volume"),
                                        F.count(F.lit(1)).alias("row_count")).select(
        days.alias("days"), "volume", "row_count")


@registered(with_views(DETECTIONS, select="""
    SELECT CAST(sum(vol) AS BIGINT) AS total_volume, count(*) AS row_count FROM det"""))
def promoted_view(spark, sf_dir):
    """A rebuilt fact behind a view, promoted because no month failed its check."""
    root = fresh_dir(spark, "rebuilt")
    view = "detections_" + root.rsplit("-", 1)[-1]
    check = lake.publish(fixtures.detections(spark, sf_dir), "M03A", root)
    lake.promote(spark, check, view, root, "M03A")
    span = TimeRange.days("2024-01-01", "2024-01-31")
    return stats.total(stats.base(spark.table(view), span, hourly=False))


@registered(with_views(DETECTIONS, select=_BY_DAY))
def stream_ingest(spark, sf_dir):
    """Landed CSV taken in by a stream in two runs; the second finds only the new files."""
    landed, root = fresh_dir(spark, "slots"), fresh_dir(spark, "ingested")
    checkpoint = fresh_dir(spark, "stream")
    rows = fixtures.detections(spark, sf_dir)
    for part in ("TimeInterval < '2024-01-20'", "TimeInterval >= '2024-01-20'"):
        rows.filter(part).write.mode("append").csv(landed)
        jobs.ingest(jobs.slots(spark, landed, "M03A"), "M03A", root, checkpoint).awaitTermination()
    return by_day(jobs.ingested(spark, root, "M03A"))


@registered(with_views(EVENTS, select=_LANDED_DAYS + """
    SELECT day, count(*) AS row_count, CAST(sum(amount) AS BIGINT) AS volume
    FROM f JOIN s USING (file_day) WHERE files = 288 GROUP BY 1"""))
def stream_complete_days(spark, sf_dir):
    """Files that land in two parts; a stream publishes the days that are complete, each once."""
    landed, root = fresh_dir(spark, "slots"), fresh_dir(spark, "lake")
    checkpoint = fresh_dir(spark, "stream")
    lines = fixtures.landing_days(spark, sf_dir)
    early = F.substring("name", 20, 2) < "12"
    for part in (early, ~early):
        fixtures.land(lines.filter(part), landed)
        jobs.publish_complete(spark, landed, "M03A", root, checkpoint).awaitTermination()
    jobs.publish_complete(spark, landed, "M03A", root, checkpoint).awaitTermination()
    rows = lake.tree(spark, root, "M03A")
    return rows.groupBy(F.when(F.col("TimeInterval") == "never", "never").otherwise(
        day_of(F.col("TimeInterval"))).alias("day")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("Volume").alias("volume"))


@registered(with_views(EVENTS, select="""
    , w AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts0) AS s, vt, sum(amount) AS volume,
                   count(*) AS row_count FROM ev GROUP BY ALL)
    SELECT strftime(s, '%Y-%m-%d %H:%M') AS window_start, vt AS "VehicleType",
           CAST(volume AS BIGINT) AS volume, row_count FROM w
    WHERE s + INTERVAL 15 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 24 DAY"""))
def stream_15min(spark, sf_dir):
    """15-minute flow on a stream; windows appear once no more data may arrive for them."""
    path, checkpoint = fresh_dir(spark, "windows"), fresh_dir(spark, "stream")
    schema = fixtures.table(spark, sf_dir, "events").schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
              .parquet(sf_dir))
    vehicle = F.lit(None).cast("int")
    for name, code in fixtures.EVENT_VEHICLE.items():
        vehicle = F.when(F.col("event_type") == name, code).otherwise(vehicle)
    rows = stream.select(F.col("ts").cast("timestamp").alias("ts"), vehicle.alias("VehicleType"),
                         F.floor("value").cast("int").alias("Volume"))
    jobs.drain(jobs.windowed_flow(rows), path, checkpoint).awaitTermination()
    stored = spark.read.schema("window_start timestamp, VehicleType int, volume bigint, "
                               "row_count bigint").parquet(path)
    return stored.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


@registered(with_views(EVENTS, select="""
    , m AS (SELECT max(ts) - INTERVAL 24 DAY AS lim FROM events),
      r AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts0) AS s, vt, amount,
                   CASE WHEN t >= '2024-01-10' THEN 2 WHEN k < 50 THEN 1 ELSE 3 END AS part FROM ev)
    SELECT CASE part WHEN 3 THEN 'late' ELSE 'window' END AS place,
           strftime(s, '%Y-%m-%d %H:%M') AS window_start, vt AS "VehicleType",
           CAST(sum(amount) AS BIGINT) AS volume, count(*) AS row_count
    FROM r, m WHERE s + INTERVAL 15 MINUTE <= lim GROUP BY ALL"""))
def stream_late_rows(spark, sf_dir):
    """Detections in three batches, the last far behind: finished windows, and what missed them."""
    source, root, checkpoint = (fresh_dir(spark, label) for label in ("source", "windows", "stream"))
    rows = fixtures.events(spark, sf_dir, None).select(
        F.col("t").cast("timestamp").alias("ts"), "VehicleType", F.col("amount").alias("Volume"), "k")
    old = F.col("ts") < F.lit("2024-01-10").cast("timestamp")
    for part in (old & (F.col("k") < 50), ~old, old & (F.col("k") >= 50)):
        rows.filter(part).drop("k").write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.drop("k").schema).parquet(source)
        jobs.split_flow(stream, root, checkpoint).awaitTermination()
    late = jobs.late_rows(spark, root, rows.drop("k").schema)
    late = late.groupBy(F.window("ts", "15 minutes")["start"].alias("window_start"), "VehicleType").agg(
        F.sum("Volume").alias("volume"), F.count(F.lit(1)).alias("row_count"))
    both = jobs.finished_windows(spark, root).select(F.lit("window").alias("place"), "*").unionByName(
        late.select(F.lit("late").alias("place"), "*"))
    return both.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


@registered(with_views(TRIPS, select="""
    SELECT vt AS "VehicleType", len AS "TripLength", count(*) AS n FROM trp GROUP BY ALL"""))
def retyped_columns(spark, sf_dir):
    """Text columns brought back to their types."""
    rows = fixtures.trips(spark, sf_dir)
    text = rows.select(F.col("VehicleType").cast("string"), F.col("TripLength").cast("string"))
    return retype(text).groupBy("VehicleType", "TripLength").agg(F.count(F.lit(1)).alias("n"))
