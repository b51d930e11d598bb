"""Landing, job-state and drift queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from roadpulse import fixtures
from roadpulse.functions.timeparts import rolling_days, spine_of
from roadpulse.operators import quality
from roadpulse.registry.book import (DETECTIONS, EVENTS, LISTING, TRIPS, grid_sql, registered,
                                     with_views)
from roadpulse.registry.facts import detections_of, listing_of, trips_of

AS_OF = date(2024, 3, 10)
#: Files of one backfill run.
BUDGET = 480
_LISTED_GRID = grid_sql("(SELECT min(day) FROM landed)", "(SELECT max(day) FROM landed)")
_ROLLING_GRID = grid_sql("DATE '2024-01-26'", "DATE '2024-03-05'")
_GAPS = (", gaps AS (SELECT dtype, day, name FROM grid "
         "WHERE name NOT IN (SELECT name FROM landed))")


def files_of(spark, sf_dir):
    return quality.landed(listing_of(spark, sf_dir))


def listed_days(spark, sf_dir):
    """Every day from the first landed one to the last."""
    return spine_of(files_of(spark, sf_dir), F.col("day"))


def gaps_of(spark, sf_dir, days=None):
    days = listed_days(spark, sf_dir) if days is None else days
    return quality.missing_slots(quality.slot_grid(days), files_of(spark, sf_dir))


def rolling(spark):
    """Forty days that end five days before the as-of day."""
    return rolling_days(spark, AS_OF, 5, 40)


def shown(df):
    """Dates as text for the comparison."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd")
                           for c, t in df.dtypes if t == "date"})


@registered(with_views(EVENTS, LISTING, _LISTED_GRID, select=_GAPS + """
    SELECT dtype, strftime(day, '%Y-%m-%d') AS day, name FROM gaps"""))
def slot_missing(spark, sf_dir):
    return shown(gaps_of(spark, sf_dir))


@registered(with_views(EVENTS, LISTING, select="""
    SELECT dtype, strftime(day, '%Y-%m-%d') AS day, name FROM landed"""))
def landed_files(spark, sf_dir):
    """Valid files: named right and not empty, type and day read off the name."""
    return shown(files_of(spark, sf_dir).select("dtype", "day", "name"))


@registered(with_views(EVENTS, LISTING, select="""
    , spine AS (SELECT unnest(generate_series((SELECT min(day) FROM landed),
                                              (SELECT max(day) FROM landed),
                                              INTERVAL 1 DAY))::DATE AS day),
      n AS (SELECT dtype, day, count(*) AS n FROM landed GROUP BY ALL),
      c AS (SELECT types.dtype, spine.day, coalesce(n, 0) AS files,
                   CASE types.dtype WHEN 'M06A' THEN 24 ELSE 288 END AS expected
            FROM spine CROSS JOIN (VALUES ('M06A'), ('M03A')) AS types(dtype)
            LEFT JOIN n ON n.day = spine.day AND n.dtype = types.dtype)
    SELECT dtype, strftime(day, '%Y-%m-%d') AS day, files, expected,
           CASE WHEN files >= expected THEN 'COMPLETE' WHEN files > 0 THEN 'PARTIAL'
                ELSE 'EMPTY' END AS state FROM c"""))
def day_completeness(spark, sf_dir):
    return shown(quality.completeness(files_of(spark, sf_dir), listed_days(spark, sf_dir)))


@registered(with_views(EVENTS, LISTING, _LISTED_GRID, select=_GAPS + """
    SELECT dtype, strftime(day, '%Y-%m-%d') AS day, name,
           row_number() OVER (ORDER BY gaps.dtype DESC, gaps.day DESC, name) <= 480 AS this_run
    FROM gaps"""))
def backfill_plan(spark, sf_dir):
    return shown(quality.backfill_plan(gaps_of(spark, sf_dir), BUDGET))


@registered(with_views(EVENTS, LISTING, _LISTED_GRID, select=_GAPS + """
    SELECT count(DISTINCT (dtype, day)) AS missing_days, count(*) AS missing_files,
           count(*) * 45 / 3600.0::DOUBLE AS hours, greatest(count(*) - 480, 0) AS left_over
    FROM gaps"""))
def backfill_totals(spark, sf_dir):
    return quality.backfill_totals(gaps_of(spark, sf_dir), BUDGET)


@registered(with_views(EVENTS, LISTING, _ROLLING_GRID, select=_GAPS + """
    SELECT dtype, strftime(day, '%Y-%m-%d') AS day, count(*) AS files FROM gaps
    GROUP BY gaps.dtype, gaps.day HAVING gaps.day < DATE '2024-03-10' - INTERVAL 35 DAY
       AND count(*) = CASE gaps.dtype WHEN 'M06A' THEN 24 ELSE 288 END"""))
def archive_route_days(spark, sf_dir):
    """Whole-day gaps over 35 days old in a rolling window."""
    return shown(quality.archive_days(gaps_of(spark, sf_dir, rolling(spark)), AS_OF))


@registered(with_views(EVENTS, LISTING, _LISTED_GRID, select=_GAPS + """
    , log AS (SELECT DISTINCT 'TDCS_M03A_' || strftime(ts0, '%Y%m%d_%H')
                     || lpad(CAST(minute(ts0) // 5 * 5 AS VARCHAR), 2, '0') || '00.csv' AS name
              FROM ev)
    SELECT dtype, strftime(day, '%Y-%m-%d') AS day, name,
           CASE WHEN name IN (SELECT name FROM log) THEN 'fail' ELSE 'source_missing' END AS verdict
    FROM gaps"""))
def missing_at_source(spark, sf_dir):
    """Gaps the source has itself, against files it offers and we lack."""
    offered = fixtures.fetch_log(spark, sf_dir).select(F.col("file").alias("name"))
    return shown(quality.missing_at_source(gaps_of(spark, sf_dir), offered))


_LOG = """, log AS (
    SELECT 'M03A' AS dtype, substr(t, 1, 10) AS day,
           'TDCS_M03A_' || strftime(ts0, '%Y%m%d_%H')
               || lpad(CAST(minute(ts0) // 5 * 5 AS VARCHAR), 2, '0') || '00.csv' AS file,
           CASE WHEN k < 70 THEN 'saved' WHEN k < 80 THEN 'skipped_exist'
                WHEN k < 90 THEN 'source_missing' ELSE 'fail' END AS status
    FROM ev)"""


@registered(with_views(EVENTS, select=_LOG + """
    SELECT dtype, count(*) FILTER (status = 'saved') AS saved,
           count(*) FILTER (status = 'fail') AS fail,
           count(*) FILTER (status = 'source_missing') AS source_missing,
           count(*) FILTER (status = 'skipped_exist') AS skipped_exist
    FROM log GROUP BY dtype"""))
def fetch_totals(spark, sf_dir):
    return quality.fetch_totals(fixtures.fetch_log(spark, sf_dir))


@registered(with_views(EVENTS, LISTING, _LISTED_GRID, select=_GAPS + _LOG + """
    , d AS (SELECT day, count(*) FILTER (status = 'saved') AS saved,
                   count(*) FILTER (status = 'fail') AS fail,
                   count(*) FILTER (status = 'source_missing') AS source_missing,
                   count(*) FILTER (status = 'skipped_exist') AS skipped_exist FROM log GROUP BY 1)
    SELECT CAST(sum(saved) AS BIGINT) AS saved, CAST(sum(fail) AS BIGINT) AS fail,
           CAST(sum(source_missing) AS BIGINT) AS source_missing,
           CAST(sum(skipped_exist) AS BIGINT) AS skipped_exist,
           count(*) FILTER (CAST(right(day, 2) AS INTEGER) % 7 = 0 AND saved + skipped_exist > 0) AS put_fail,
           (SELECT greatest(count(*) - 480, 0) FROM gaps) AS left_over FROM d"""))
def fetch_run(spark, sf_dir):
    """Totals of a backfill run; uploads of every seventh day of a month failed."""
    log = fixtures.fetch_log(spark, sf_dir)
    puts = log.select("dtype", "day", F.when(F.right("day", F.lit(2)).cast("int") % 7 == 0, 1)
                      .otherwise(0).alias("code")).distinct()
    return quality.run_totals(log, puts, gaps_of(spark, sf_dir), BUDGET)


@registered(with_views(EVENTS, select=_LOG + """
    , s AS (SELECT strftime(unnest(generate_series((SELECT min(day)::DATE FROM log),
                                                   (SELECT max(day)::DATE FROM log),
                                                   INTERVAL 1 DAY)), '%Y-%m-%d') AS day),
      c AS (SELECT s.day, 'M03A' AS dtype,
                   count(log.day) FILTER (status <> 'source_missing') AS found,
                   count(*) FILTER (status = 'saved') AS saved,
                   count(*) FILTER (status = 'fail') AS fail
            FROM s LEFT JOIN log ON log.day = s.day GROUP BY s.day)
    SELECT *, CASE WHEN found = 0 THEN 'NO_SOURCE' WHEN fail = 0 THEN 'OK' ELSE 'INCOMPLETE' END
           AS state FROM c"""))
def fetch_reconcile(spark, sf_dir):
    log = fixtures.fetch_log(spark, sf_dir)
    return quality.reconcile(log, spine_of(log, F.col("day").cast("date")))


@registered(with_views(EVENTS, select=_LOG + """
    SELECT DISTINCT dtype, day, file FROM log WHERE status = 'fail'"""))
def failed_files(spark, sf_dir):
    return quality.failed_files(fixtures.fetch_log(spark, sf_dir))


_STATE = """WITH log AS (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           CASE o_orderstatus WHEN 'F' THEN 'OK' WHEN 'O' THEN 'MISMATCH' ELSE 'ERROR' END AS status,
           strftime(o_orderdate, '%Y-%m-%d') || 'T' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')
               AS stamp FROM orders),
  state AS (SELECT year, month, arg_max(status, stamp) AS status FROM log GROUP BY ALL)"""


@registered(_STATE + " SELECT * FROM state")
def latest_state(spark, sf_dir):
    return quality.latest_state(fixtures.job_state(spark, sf_dir))


@registered(_STATE + " SELECT status, count(*) AS partitions FROM state GROUP BY status")
def status_summary(spark, sf_dir):
    return quality.status_summary(quality.latest_state(fixtures.job_state(spark, sf_dir)))


@registered(_STATE + """
    SELECT DISTINCT year, month FROM log
    WHERE (year, month) NOT IN (SELECT (year, month) FROM state WHERE status = 'OK')""")
def resume_months(spark, sf_dir):
    log = fixtures.job_state(spark, sf_dir)
    return quality.resume_months(quality.months_present(log), quality.latest_state(log))


@registered("""
    SELECT DISTINCT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month
    FROM orders""")
def months_present(spark, sf_dir):
    return quality.months_present(fixtures.landed_orders(spark, sf_dir))


@registered("""
    WITH raw AS (SELECT DISTINCT strftime(o_orderdate, '%Y') AS year,
                        strftime(o_orderdate, '%m') AS month FROM orders),
         asked AS (SELECT DISTINCT strftime(l_shipdate, '%Y') AS year,
                          strftime(l_shipdate, '%m') AS month FROM lineitem)
    SELECT year, month, (year, month) IN (SELECT (year, month) FROM raw) AS present FROM asked""")
def requested_months(spark, sf_dir):
    """Asked months (those of the shipments) with and without raw data."""
    shipped = F.col("l_shipdate").cast("string")
    asked = fixtures.table(spark, sf_dir, "lineitem").select(
        F.substring(shipped, 1, 4).alias("year"), F.substring(shipped, 6, 2).alias("month"))
    return quality.requested_months(fixtures.landed_orders(spark, sf_dir), asked)


@registered("""
    WITH o AS (SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
                      month(o_orderdate) AS m, o_orderstatus AS s FROM orders),
         c AS (SELECT year, month, any_value(m) AS m, count(*) AS raw_files,
                      count(*) FILTER (m % 2 = 0 OR s <> 'P') AS stamped FROM o GROUP BY ALL)
    SELECT 'M06A' AS dtype, year, month, raw_files,
           CASE WHEN m = 12 THEN 'unpublished' WHEN m % 5 = 0 THEN 'no stamp' ELSE 'changed' END
               AS reason
    FROM c WHERE m = 12 OR m % 5 = 0 OR stamped <> raw_files""")
def stale_months(spark, sf_dir):
    manifest = fixtures.order_manifest(spark, sf_dir)
    return quality.stale_months(fixtures.landed_orders(spark, sf_dir), manifest, manifest)


@registered(with_views(EVENTS, LISTING, select="""
    SELECT 'M06A' AS dtype, strftime(day, '%Y-%m-%d') AS day FROM landed
    WHERE dtype = 'M06A' AND landed.day NOT IN (
        SELECT CAST(ts0 AS DATE) FROM ev WHERE event_type = 'view' AND k = 0)
    GROUP BY landed.day HAVING count(*) >= 24"""))
def ready_days(spark, sf_dir):
    """Complete days not published yet; published are those with a view event of ``k`` 0."""
    published = fixtures.table(spark, sf_dir, "events").filter(
        (F.get_json_object("props", "$.k") == "0") & (F.col("event_type") == "view")).select(
        F.col("ts").cast("date").alias("day"))
    state = quality.completeness(files_of(spark, sf_dir), listed_days(spark, sf_dir))
    return shown(quality.ready_days(state, published, "M06A"))


@registered(with_views(DETECTIONS, select="""
    SELECT min(ti) AS min_time, max(ti) AS max_time, count(DISTINCT substr(ti, 1, 10)) AS days
    FROM det"""))
def date_profile(spark, sf_dir):
    return quality.date_profile(detections_of(spark, sf_dir), "TimeInterval")


@registered("""SELECT strftime(date_trunc('month', min(o_orderdate)), '%Y-%m-%d') AS min_date,
                      strftime(last_day(max(o_orderdate)), '%Y-%m-%d') AS max_date FROM orders""")
def month_coverage(spark, sf_dir):
    """Days covered by month partitions."""
    return shown(quality.coverage(quality.months_present(fixtures.landed_orders(spark, sf_dir))))


@registered(with_views(EVENTS, LISTING, select="""
    SELECT strftime(min(day), '%Y-%m-%d') AS min_date, strftime(max(day), '%Y-%m-%d') AS max_date
    FROM landed"""))
def day_coverage(spark, sf_dir):
    return shown(quality.day_coverage(files_of(spark, sf_dir)))


@registered("""
    WITH b AS (SELECT date_trunc('month', min(o_orderdate)) AS lo, last_day(max(o_orderdate)) AS hi
               FROM orders)
    SELECT strftime(l_shipdate, '%Y-%m-%d') AS start_date,
           strftime(l_shipdate + INTERVAL 6 DAY, '%Y-%m-%d') AS end_date,
           l_shipdate + INTERVAL 6 DAY >= lo AND l_shipdate <= hi AS covered
    FROM lineitem, b GROUP BY ALL""")
def request_coverage(spark, sf_dir):
    """Week-long requests (from each shipping day) against the covered months."""
    day = F.col("l_shipdate").cast("date")
    asked = fixtures.table(spark, sf_dir, "lineitem").select(
        day.alias("start_date"), F.date_add(day, 6).alias("end_date")).distinct()
    covered = quality.coverage(quality.months_present(fixtures.landed_orders(spark, sf_dir)))
    return shown(quality.inside_coverage(asked, covered))


_DROPS = """, a AS (SELECT {key} AS key, count(*) AS raw_count FROM trp GROUP BY 1),
    b AS (SELECT {key} AS key, count(*) AS new_count FROM trp WHERE fin = 'Y' GROUP BY 1)
  SELECT key AS {name}, raw_count, new_count,
         round(new_count / raw_count::DOUBLE, 3) AS ratio FROM a FULL JOIN b USING (key) {tail}"""


@registered(with_views(TRIPS, select=_DROPS.format(key="vt", name='"VehicleType"', tail="")))
def drop_compare_vehicle(spark, sf_dir):
    """The whole drop against the cleaned one (trips that ended) by vehicle."""
    whole = trips_of(spark, sf_dir)
    return quality.compare_drops(whole, whole.filter("TripEnd = 'Y'"), F.col("VehicleType"),
                                 "VehicleType")


@registered(with_views(TRIPS, select=_DROPS.format(key="substr(time_o, 1, 10)", name="day",
                                                   tail="")))
def drop_compare_day(spark, sf_dir):
    """The same by day."""
    whole = trips_of(spark, sf_dir)
    return quality.compare_drops(whole, whole.filter("TripEnd = 'Y'"),
                                 F.substring("DetectionTime_O", 1, 10), "day")


@registered(with_views(TRIPS, select="""
    SELECT c.column AS "column", c.type AS left_type, (SELECT count(*) FROM trp) AS left_rows,
           'string' AS right_type, (SELECT count(*) FROM trp WHERE fin = 'Y') AS right_rows,
           c.type = 'string' AS same
    FROM (VALUES ('VehicleType', 'int'), ('DetectionTime_O', 'string'), ('GantryID_O', 'string'),
                 ('DetectionTime_D', 'string'), ('GantryID_D', 'string'), ('TripLength', 'double'),
                 ('TripEnd', 'string'), ('TripInformation', 'string')) AS c("column", type)"""))
def schema_diff(spark, sf_dir):
    """Trips against an all-text drop of them: rows and column types."""
    whole = trips_of(spark, sf_dir).drop("year", "month")
    text = whole.filter("TripEnd = 'Y'").select(*[F.col(c).cast("string") for c in whole.columns])
    return quality.schema_diff(whole, text)


@registered(with_views(EVENTS, LISTING, select="""
    SELECT strftime(day, '%Y') AS year, strftime(day, '%m') AS month,
           count(DISTINCT landed.day) AS days, count(*) AS files FROM landed GROUP BY 1, 2"""))
def days_per_month(spark, sf_dir):
    return quality.days_per_month(files_of(spark, sf_dir).select(
        F.date_format("day", "yyyy").alias("year"), F.date_format("day", "MM").alias("month"),
        "day"))


@registered("""
    SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
           CAST(sum(CAST(floor(o_totalprice) AS BIGINT) * 100) AS BIGINT) AS bytes,
           count(*) AS files,
           CAST(greatest(1, round_even(
               sum(CAST(floor(o_totalprice) AS BIGINT) * 100)
               / 134217728.0::DOUBLE, 0)) AS INTEGER) AS target_files
    FROM orders GROUP BY 1, 2""")
def compaction_plan(spark, sf_dir):
    """File count per month from bytes; each order stands for a file of its price in bytes."""
    files = fixtures.table(spark, sf_dir, "orders").select(
        F.substring(F.col("o_orderdate").cast("string"), 1, 4).alias("year"),
        F.substring(F.col("o_orderdate").cast("string"), 6, 2).alias("month"),
        (F.floor("o_totalprice") * 100).alias("length"))
    return quality.file_plan(files)


@registered(with_views(EVENTS, LISTING, select="""
    , b AS (SELECT min(day) AS lo, max(day) AS hi FROM landed),
      s AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS day FROM b)
    SELECT strftime(s.day, '%Y-%m-%d') AS day, count(name) AS files
    FROM s LEFT JOIN landed ON landed.day = s.day GROUP BY s.day"""))
def day_spine_files(spark, sf_dir):
    """Every day between the first and the last landed one with its files."""
    files = files_of(spark, sf_dir)
    counted = files.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return shown(spine_of(files, F.col("day")).join(counted, "day", "left").select(
        "day", F.coalesce("n", F.lit(0)).alias("files")))
