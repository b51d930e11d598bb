"""The daily conversion: landed CSV to the verified lake.

A ledger of source files, published in the same version as their rows, tells what the lake
holds: days and months are judged by names and lengths of files, never by the times in them.
Files the ledger lacks are added as a new batch. Files that landed again in another length, or
all of a range with ``force``, take the place of their own rows, which are known by the file
name stored with them; only the months of those are written again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.timeparts import day_spine
from roadpulse.operators import quality
from roadpulse.schemas import FACTS
from roadpulse.session import cut_lineage
from roadpulse.sources import lake, landing, snapshots


def name_pattern(dtype: str, stamps: Sequence[str]) -> str:
    """Glob of the file names that have one of ``stamps`` (``yyyyMMdd`` or ``yyyyMM``)."""
    some = ",".join(stamp + "[0-9]" * (8 - len(stamp)) for stamp in stamps)
    return f"TDCS_{dtype}_{{{some}}}_*.csv"


def landed_rows(spark: SparkSession, landing_root: str, dtype: str,
                stamps: Sequence[str]) -> DataFrame:
    """CSV rows of one type, of the files whose name has one of ``stamps`` (``yyyyMMdd`` or
    ``yyyyMM``), with path, name, day and filing month of the file; other files are not opened.

    The month a row is filed under is that of its file, which need not be that
    of its own time.
    """
    raw = (spark.read.schema(FACTS[dtype]).option("mode", "PERMISSIVE")
           .option("recursiveFileLookup", "true")
           .option("pathGlobFilter", name_pattern(dtype, stamps)).csv(landing_root))
    name = F.col("_metadata.file_name")
    stamp = F.substring(name, 11, 8)
    year, month = F.substring(stamp, 1, 4), F.substring(stamp, 5, 2)
    day = F.concat_ws("-", year, month, F.substring(stamp, 7, 2)).try_cast("date")
    return raw.withColumns({"year": year, "month": month, "file_day": day,
                            "path": F.col("_metadata.file_path"), snapshots.SOURCE_FILE: name})


def take(spark: SparkSession, landing_root: str, lake_root: str, dtype: str,
         files: DataFrame) -> DataFrame:
    """Publish landed files (name, day, length, path); the count check per month.

    Rows of files of these names that the lake holds already go. The driver holds the months
    of the files, and their days.
    """
    base = snapshots.latest(spark, lake_root)
    files = cut_lineage(files.select(
        "name", "length", "path", F.date_format("day", "yyyy").alias("year"),
        F.date_format("day", "MM").alias("month"), F.date_format("day", "yyyyMMdd").alias("stamp")))
    stamps = sorted(r["stamp"] for r in files.select("stamp").distinct().collect())
    if not stamps:
        return lake.no_check(spark)
    ledger = snapshots.sources(spark, lake_root, base)
    again = quality.published_before(ledger, files).select(*lake.MONTH_KEYS).distinct().collect()
    months = {(r["year"], r["month"]) for r in again}
    live = [e for e in snapshots.entries(spark, lake_root, base) if e[:2] in months]

    schema = lake.with_source(dtype)
    names = [*schema.names, *lake.MONTH_KEYS]
    # A name may have landed in two folders; rows come from the chosen one.
    fresh = landed_rows(spark, landing_root, dtype, stamps).join(
        files.select("path"), "path", "left_semi").select(*names)
    held = snapshots.read(spark, lake_root, schema, lambda e: e[:2] in months, base)
    gone = files.select(F.col("name").alias(snapshots.SOURCE_FILE))
    kept = held.join(gone, snapshots.SOURCE_FILE, "left_anti").select(*names)
    rows = lake.filed(fresh.unionByName(kept), dtype) \
        .sortWithinPartitions(*lake.MONTH_KEYS, *lake.FILE_ORDER[dtype])
    batch, check = lake.write_batch(rows, lake_root, base, schema)

    old = ledger.filter(F.concat("year", "month").isin([y + m for y, m in months])) \
        .join(files.select("name"), "name", "left_anti")
    columns = ["name", "length", *lake.MONTH_KEYS]
    now = cut_lineage(files.select(*columns).unionByName(old.select(*columns)))
    lake.write_sources(now, lake_root, batch)
    known = lake.by_month(now)
    # A month whose files hold no row has no count, yet its files are published.
    counts = {(y, m): (n, status) for y, m, n, _, status in check}
    check += [(y, m, 0, 0, "OK") for y, m in sorted(set(known) - set(counts))]
    good = [snapshots.Entry(y, m, batch, n, known.get((y, m), 0))
            for y, m, n, _, status in check if status == "OK"]
    if good:
        snapshots.commit(spark, lake_root, base, good, {e[:2] for e in live} & {e[:2] for e in good})
    return lake.check_rows(spark, sorted(check))


def convert_days(spark: SparkSession, landing_root: str, lake_root: str, first: date, last: date,
                 force: bool = False) -> DataFrame:
    """Detections: add the files of the complete days of a range that the lake does not hold yet.

    Only files of those days are read. With ``force`` every landed file of the range is taken
    again, those of incomplete days too, in place of its stored rows. Days whose files left the
    landing folder stay. Returns the count check per month.
    """
    files = quality.landed_paths(landing.listing(spark, landing_root, uri=True)).filter(
        (F.col("dtype") == "M03A") & F.col("day").between(F.lit(first), F.lit(last)))
    if not force:
        state = quality.completeness(files, day_spine(spark, first, last))
        complete = state.filter("dtype = 'M03A' and state = 'COMPLETE'").select("day")
        files = quality.unpublished(files.join(complete, "day", "left_semi"),
                                    snapshots.sources(spark, lake_root))
    return take(spark, landing_root, lake_root, "M03A", files)


def convert_given(spark: SparkSession, landing_root: str, lake_root: str, dtype: str,
                  days: Sequence[date]) -> DataFrame:
    """Add the landed files of the given days that the lake does not hold yet; the count check.

    Only files of those days are listed and read. A second call finds nothing to add.
    """
    if not days:
        return lake.no_check(spark)
    pattern = name_pattern(dtype, sorted({day.strftime("%Y%m%d") for day in days}))
    files = quality.landed_paths(landing.listing(spark, landing_root, uri=True, names=pattern))
    return take(spark, landing_root, lake_root, dtype,
                quality.unpublished(files, snapshots.sources(spark, lake_root)))


def convert_months(spark: SparkSession, landing_root: str, lake_root: str,
                   manifest: str) -> DataFrame:
    """Trips: add every landed file that the lake does not hold yet, and stamp its month.

    A stamp holds the number of files that the lake has of the month. Only files of months
    with something to add are read.
    """
    files = quality.landed_paths(landing.listing(spark, landing_root, uri=True)).filter(
        "dtype = 'M06A' and day is not null")
    check = take(spark, landing_root, lake_root, "M06A",
                 quality.unpublished(files, snapshots.sources(spark, lake_root)))
    counts = snapshots.sources(spark, lake_root).groupBy(*lake.MONTH_KEYS).agg(
        F.count(F.lit(1)).alias("raw_count"))
    done = check.filter("status = 'OK'").select(*lake.MONTH_KEYS)
    lake.stamp(counts.join(done, lake.MONTH_KEYS, "left_semi").select(
        F.lit("M06A").alias("dtype"), *lake.MONTH_KEYS, "raw_count"), manifest)
    return check
