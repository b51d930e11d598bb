"""Landing records and lake checks: completeness, gaps, backfill, drift, staleness."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.paths import computed_once
from roadpulse.schemas import FILE_NAME, MINUTES_PER_FILE, files_per_day

# Seconds between two source requests, age at which the source
# keeps whole-day archives only, bytes of a lake file.
SECONDS_PER_FETCH = 45
ARCHIVE_AGE_DAYS = 35
TARGET_FILE_BYTES = 128 * 1024 * 1024


def parsed_names(listing: DataFrame, column: str = "path") -> DataFrame:
    """Type, day, ``HHmm`` and bare name out of landed file names; other files fall out."""
    stamp = F.substring("name", 11, 8)
    day = F.concat_ws("-", F.substring(stamp, 1, 4), F.substring(stamp, 5, 2),
                      F.substring(stamp, 7, 2))
    kept = [c for c in listing.columns if c != "name"]
    named = listing.select(*kept, computed_once(F.regexp_extract(column, FILE_NAME, 0))
                           .alias("name"))
    return named.filter("name <> ''").withColumns({
        "dtype": F.substring("name", 6, 4), "day": day.try_cast("date"),
        "hhmm": F.substring("name", 20, 4)})


def landed(listing: DataFrame) -> DataFrame:
    """Valid landed files: named right and not empty, each name once."""
    return (parsed_names(listing).filter("length > 0")
            .select("dtype", "day", "hhmm", "name").distinct())


def landed_paths(listing: DataFrame) -> DataFrame:
    """Valid landed files with path and length; of several files of one name the longest counts."""
    best = F.max(F.struct("length", "path"))
    return (parsed_names(listing).filter("length > 0").groupBy("dtype", "day", "hhmm", "name")
            .agg(best.alias("best")).select("dtype", "day", "hhmm", "name", "best.length", "best.path"))


def unpublished(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Landed files that the ledger of published files lacks, or has in another length."""
    return files.join(ledger.select("name", "length"), ["name", "length"], "left_anti")


def published_before(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Landed files of which the lake already holds rows, in this or another length."""
    return files.join(ledger.select("name"), "name", "left_semi")


def slot_grid(days: DataFrame, dtypes: tuple[str, ...] = ("M06A", "M03A")) -> DataFrame:
    """Every file a day should have, for both types: (dtype, day, name)."""
    types = F.array(*[F.struct(F.lit(t).alias("dtype"), F.lit(MINUTES_PER_FILE[t]).alias("step"))
                      for t in dtypes])
    spread = days.select("day", F.inline(types)).select(
        "day", "dtype", F.explode(F.sequence(F.lit(0), F.lit(24 * 60 - 1), F.col("step")))
        .alias("minute"))
    return spread.select("dtype", "day", F.format_string(
        "TDCS_%s_%s_%02d%02d00.csv", "dtype", F.date_format("day", "yyyyMMdd"),
        F.floor(F.col("minute") / 60), F.col("minute") % 60).alias("name"))


def missing_slots(grid: DataFrame, files: DataFrame) -> DataFrame:
    """Expected files that have not landed."""
    return grid.join(files.select("name"), "name", "left_anti").select("dtype", "day", "name")


def expected_files(dtype: Column) -> Column:
    return F.when(dtype == "M06A", files_per_day("M06A")).otherwise(files_per_day("M03A"))


def completeness(files: DataFrame, days: DataFrame) -> DataFrame:
    """Per type and day: files landed, files expected, COMPLETE, PARTIAL or EMPTY."""
    spine = days.select("day", F.explode(F.array(F.lit("M06A"), F.lit("M03A"))).alias("dtype"))
    counted = files.groupBy("dtype", "day").agg(F.count(F.lit(1)).alias("n"))
    have = F.coalesce("n", F.lit(0))
    want = expected_files(F.col("dtype"))
    return spine.join(counted, ["dtype", "day"], "left").select(
        "dtype", "day", have.alias("files"), want.alias("expected"),
        F.when(have >= want, "COMPLETE").when(have > 0, "PARTIAL").otherwise("EMPTY")
        .alias("state"))


def backfill_plan(missing: DataFrame, budget: int) -> DataFrame:
    """All missing files, and whether the next run of ``budget`` fetches takes them.

    Trips go before detections, newest day first, by name.
    """
    taken = missing.orderBy(F.desc("dtype"), F.desc("day"), "name").limit(budget).select(
        "name", F.lit(True).alias("taken"))
    return missing.join(taken, "name", "left").select(
        "dtype", "day", "name", F.coalesce("taken", F.lit(False)).alias("this_run"))


def backfill_totals(missing: DataFrame, budget: int) -> DataFrame:
    """Missing days and files, hours to fetch them, files left for the next run."""
    per_day = missing.groupBy("dtype", "day").agg(F.count(F.lit(1)).alias("n"))
    return per_day.agg(
        F.count(F.lit(1)).alias("missing_days"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("missing_files"),
        (F.coalesce(F.sum("n"), F.lit(0)) * SECONDS_PER_FETCH / 3600.0).alias("hours"),
        F.greatest(F.coalesce(F.sum("n"), F.lit(0)) - budget, F.lit(0)).alias("left_over"))


def archive_days(missing: DataFrame, as_of: date) -> DataFrame:
    """Whole-day gaps so old that only the source's daily archive still has them."""
    cut = F.lit((as_of - timedelta(days=ARCHIVE_AGE_DAYS)).isoformat()).cast("date")
    return (missing.groupBy("dtype", "day").agg(F.count(F.lit(1)).alias("files"))
            .filter((F.col("files") == expected_files(F.col("dtype"))) & (F.col("day") < cut)))


def missing_at_source(missing: DataFrame, source_listing: DataFrame) -> DataFrame:
    """Missing files split by whether the source has them: its gap or ours."""
    there = source_listing.select("name", F.lit(True).alias("at_source")).distinct()
    return missing.join(there, "name", "left").select(
        "dtype", "day", "name",
        F.when(F.col("at_source"), "fail").otherwise("source_missing").alias("verdict"))


def fetch_totals(log: DataFrame) -> DataFrame:
    """Outcomes of fetch attempts per type."""
    return log.groupBy("dtype").agg(*[
        F.count_if(F.col("status") == status).alias(status)
        for status in ("saved", "fail", "source_missing", "skipped_exist")])


def run_totals(log: DataFrame, puts: DataFrame, missing: DataFrame, budget: int) -> DataFrame:
    """One row for a backfill run: fetch outcomes, days whose upload failed, files left over.

    A day is uploaded if the run saved a file of it or found one saved before; ``puts`` has
    the exit code of each upload (dtype, day, code). What is beyond ``budget`` waits.
    """
    outcomes = ("saved", "fail", "source_missing", "skipped_exist")
    per_day = log.groupBy("dtype", "day").agg(*[
        F.count_if(F.col("status") == status).alias(status) for status in outcomes])
    failed = puts.filter("code <> 0").select("dtype", "day", F.lit(1).alias("put")).distinct()
    summed = per_day.join(failed, ["dtype", "day"], "left").agg(
        *[F.coalesce(F.sum(status), F.lit(0)).alias(status) for status in outcomes],
        F.count_if(F.col("put").isNotNull() & ((F.col("saved") > 0) | (F.col("skipped_exist") > 0)))
        .alias("put_fail"))
    waiting = missing.agg(F.greatest(F.count(F.lit(1)) - budget, F.lit(0)).alias("n")).scalar()
    return summed.withColumn("left_over", waiting)


def reconcile(log: DataFrame, days: DataFrame, dtypes: tuple[str, ...] = ("M03A",)) -> DataFrame:
    """Per type and day: files found at the source, saved and failed, and the verdict."""
    spine = days.select(F.date_format("day", "yyyy-MM-dd").alias("day"),
                        F.explode(F.array(*[F.lit(t) for t in dtypes])).alias("dtype"))
    counted = log.groupBy("dtype", "day").agg(
        F.count_if(F.col("status") != "source_missing").alias("found"),
        F.count_if(F.col("status") == "saved").alias("saved"),
        F.count_if(F.col("status") == "fail").alias("fail"))
    numbers = {c: F.coalesce(c, F.lit(0)) for c in ("found", "saved", "fail")}
    return spine.join(counted, ["dtype", "day"], "left").withColumns(numbers).withColumn(
        "state", F.when(F.col("found") == 0, "NO_SOURCE").when(F.col("fail") == 0, "OK")
        .otherwise("INCOMPLETE"))


def failed_files(log: DataFrame) -> DataFrame:
    """Files to fetch again, one row each."""
    return log.filter("status = 'fail'").select("dtype", "day", "file").distinct()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def date_profile(df: DataFrame, time: str) -> DataFrame:
    """First and last time and the number of distinct days."""
    per_day = df.groupBy(F.substring(time, 1, 10).alias("day")).agg(
        F.min(time).alias("low"), F.max(time).alias("high"))
    return per_day.agg(F.min("low").alias("min_time"), F.max("high").alias("max_time"),
                       F.count("day").alias("days"))


def compare_drops(left: DataFrame, right: DataFrame, key: Column, name: str) -> DataFrame:
    """Row counts of two data drops side by side per key, with their ratio."""
    a = left.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("raw_count"))
    b = right.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("new_count"))
    return a.join(b, name, "full").withColumn(
        "ratio", F.round(F.col("new_count") / F.col("raw_count"), 3))


def schema_rows(df: DataFrame, drop: str) -> DataFrame:
    """Row count and one row per column with its type."""
    fields = F.array(*[F.struct(F.lit(f.name).alias("column"),
                                F.lit(f.dataType.simpleString()).alias("type"))
                       for f in df.schema.fields])
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(drop).alias("drop"), "rows", F.inline(fields))


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of two drops side by side and whether their types agree."""
    a = schema_rows(left, "left").select("column", F.col("type").alias("left_type"),
                                         F.col("rows").alias("left_rows"))
    b = schema_rows(right, "right").select("column", F.col("type").alias("right_type"),
                                           F.col("rows").alias("right_rows"))
    return a.join(b, "column", "full").withColumn(
        "same", F.col("left_type").eqNullSafe(F.col("right_type")))


def months_present(df: DataFrame) -> DataFrame:
    return df.select("year", "month").distinct()


def coverage(months: DataFrame) -> DataFrame:
    """First day of the first month to last day of the last one."""
    first = F.concat_ws("-", "year", "month", F.lit("01")).try_cast("date")
    bounds = months.agg(F.min(first).alias("min_date"), F.max(first).alias("last_month"))
    return bounds.select("min_date", F.last_day("last_month").alias("max_date"))


def day_coverage(days: DataFrame, column: str = "day") -> DataFrame:
    return days.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))


def inside_coverage(requests: DataFrame, covered: DataFrame) -> DataFrame:
    """Requests (``start_date``, ``end_date``) and whether they touch the covered days."""
    days = covered.select(F.struct("min_date", "max_date")).scalar()
    return requests.withColumn("covered", (F.col("end_date") >= days.getField("min_date"))
                               & (F.col("start_date") <= days.getField("max_date")))


def latest_state(log: DataFrame) -> DataFrame:
    """Last record per month partition."""
    return log.groupBy("year", "month").agg(F.max_by("status", "timestamp").alias("status"))


def status_summary(states: DataFrame) -> DataFrame:
    return states.groupBy("status").agg(F.count(F.lit(1)).alias("partitions"))


def resume_months(months: DataFrame, states: DataFrame) -> DataFrame:
    """Months still to do: those whose last record is not OK."""
    return months.join(states.filter("status = 'OK'"), ["year", "month"], "left_anti")


def requested_months(months: DataFrame, asked: DataFrame) -> DataFrame:
    """Asked months and whether raw data of them exist."""
    there = months.select("year", "month").distinct().withColumn("there", F.lit(True))
    return asked.select("year", "month").distinct().join(there, ["year", "month"], "left").select(
        "year", "month", F.coalesce("there", F.lit(False)).alias("present"))


def stale_months(raw: DataFrame, manifest: DataFrame, published: DataFrame) -> DataFrame:
    """Months to convert again, and why: raw files changed, no stamp, or not published."""
    counted = raw.groupBy("dtype", "year", "month").agg(F.count(F.lit(1)).alias("raw_files"))
    keys = ["dtype", "year", "month"]
    there = published.select(*keys).distinct().withColumn("published", F.lit(True))
    joined = counted.join(manifest, keys, "left").join(there, keys, "left")
    reason = (F.when(F.col("published").isNull(), "unpublished")
              .when(F.col("raw_count").isNull(), "no stamp")
              .when(F.col("raw_count") != F.col("raw_files"), "changed"))
    return joined.withColumn("reason", reason).filter("reason is not null").select(
        *keys, "raw_files", "reason")


def ready_days(complete: DataFrame, published: DataFrame, dtype: str = "M03A") -> DataFrame:
    """Days whose files all landed and that are not in the lake yet."""
    full = complete.filter((F.col("dtype") == dtype) & (F.col("state") == "COMPLETE"))
    return full.join(published.select("day").distinct(), "day", "left_anti").select("dtype", "day")


def count_check(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Row counts of source and target per partition, null keys too: OK or MISMATCH."""
    a = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("src"))
    b = target.groupBy(*keys).agg(F.count(F.lit(1)).alias("dst"))
    numbers = {c: F.coalesce(c, F.lit(0)) for c in ("src", "dst")}
    for key in keys:
        b = b.withColumnRenamed(key, f"{key}_there")
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"{key}_there")) for key in keys])
    there = {key: F.coalesce(key, f"{key}_there") for key in keys}
    return a.join(b, same, "full").withColumns({**numbers, **there}).select(
        *keys, F.col("src").alias("src_count"), F.col("dst").alias("dst_count"),
        F.when(F.col("src") == F.col("dst"), "OK").otherwise("MISMATCH").alias("status"))


def file_plan(files: DataFrame, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Files a month should be rewritten to: its bytes over the target size, at least one."""
    sized = files.groupBy("year", "month").agg(F.sum("length").alias("bytes"),
                                               F.count(F.lit(1)).alias("files"))
    wanted = F.greatest(F.lit(1), F.bround(F.col("bytes") / target_bytes))
    return sized.withColumn("target_files", wanted.cast("int"))


def days_per_month(files: DataFrame) -> DataFrame:
    """Days and files of each month of a listing with ``day`` partitions."""
    per_day = files.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))
    return per_day.groupBy("year", "month").agg(F.count(F.lit(1)).alias("days"),
                                                F.sum("n").alias("files"))
