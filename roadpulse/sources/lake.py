"""The lake: Parquet partitioned by text ``year`` and two-digit ``month``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.functions.timeparts import TimeRange, month_in, months_of
from roadpulse.operators.quality import TARGET_FILE_BYTES, file_plan
from roadpulse.schemas import (FACT_TIME, FACTS, columns_to_retype, file_month,
                               partition_text)
from roadpulse.session import cut_lineage
from roadpulse.sources import snapshots
from roadpulse.sources.landing import listed_partitions, listing

MONTH_KEYS = snapshots.MONTH_KEYS
_PARTITIONS = [T.StructField(key, T.StringType()) for key in MONTH_KEYS]

# Sort order inside lake files: time first, so that row-group statistics carry a time filter.
FILE_ORDER = {"M03A": ["TimeInterval", "GantryID", "Direction", "VehicleType"],
              "M06A": ["DetectionTime_O", "GantryID_O", "DetectionTime_D", "TripInformation"]}


def lake_schema(dtype: str) -> T.StructType:
    return T.StructType(FACTS[dtype].fields + _PARTITIONS)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet under a given schema; a missing path is an empty table, not an error."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def tree(spark: SparkSession, root: str, dtype: str) -> DataFrame:
    """All months of a fact: its newest version, or plain month folders if it has none.

    The schema is given, so partition text keeps its padding and no file is
    opened for inference.
    """
    if snapshots.latest(spark, root):
        return snapshots.read(spark, root, FACTS[dtype])
    return read_or_empty(spark, root, lake_schema(dtype))


def scan(spark: SparkSession, root: str, dtype: str, span: TimeRange) -> DataFrame:
    """A fact pruned to the months of a range, a day wider at both ends."""
    if snapshots.latest(spark, root):
        inside = month_in(span)
        return snapshots.read(spark, root, FACTS[dtype], lambda e: inside(e.year, e.month))
    return tree(spark, root, dtype).filter(months_of(span))


def mixed_layout(spark: SparkSession, root: str, dtype: str, span: TimeRange | None = None) -> DataFrame:
    """A fact stored partly by day, partly by month: two reads, one union.

    One read over both layouts fails on conflicting partition columns. A range prunes the
    months of both, a day wider at both ends.
    """
    schema = lake_schema(dtype)
    parts = []
    for pattern in ("year=*/month=*/day=*", "year=*/month=*/*.parquet"):
        given = T.StructType(schema.fields + [T.StructField("day", T.StringType())]
                             if "day" in pattern else schema.fields)
        try:
            parts.append(spark.read.schema(given).option("basePath", root)
                         .parquet(f"{root}/{pattern}").select(*schema.names))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if not parts:
        return spark.createDataFrame([], schema)
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both if span is None else both.filter(months_of(span))


def write_files(df: DataFrame, path: str, files: int) -> None:
    """A folder of a fixed number of files, neighbours merged without a shuffle."""
    df.coalesce(files).write.mode("overwrite").parquet(path)


def write_months(df: DataFrame, root: str) -> None:
    """Replace the months that ``df`` holds; other months stay."""
    (partition_text(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*MONTH_KEYS).parquet(root))


def ranged(df: DataFrame, order: Sequence[str], files: int) -> DataFrame:
    """Rows spread over ``files`` tasks of about equal size, in month and time order.

    Ranges split inside a month, so a month that holds a third of all rows gets a
    third of the tasks, and each file covers a short stretch of time. Rows equal
    in every key split by the task that read them, which a retry does not change.
    """
    keys = [*MONTH_KEYS, *order, "_task"]
    return (df.withColumn("_task", F.spark_partition_id()).repartitionByRange(files, *keys)
            .sortWithinPartitions(*keys).drop("_task"))


def compact(df: DataFrame, dtype: str, root: str, files: int, keep_order: bool = False) -> None:
    """Rewrite months into about ``files`` files in all, sorted by time.

    With ``keep_order`` the input tasks, already in time order, are merged
    without a shuffle; that can only lower their number.
    """
    order = FILE_ORDER[dtype]
    rows = (df.coalesce(files).sortWithinPartitions(*MONTH_KEYS, *order) if keep_order
            else ranged(df, order, files))
    write_months(rows.select(*lake_schema(dtype).names), root)


#: The partition of rows whose time cannot be read.
BAD_TIME = {"year": "0000", "month": "00"}
_CHECK = "year string, month string, src_count bigint, dst_count bigint, status string"
#: Months that one write can count on the way; with more the source is counted by itself.
MOST_MONTHS = 2400


def no_check(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], _CHECK)


def check_rows(spark: SparkSession, check: list[tuple]) -> DataFrame:
    return spark.createDataFrame(check, _CHECK)


def filed(df: DataFrame, dtype: str) -> DataFrame:
    """Rows with the month they are stored under: given, or that of their own time.

    What is no month goes to ``BAD_TIME``.
    """
    rows = partition_text(df if set(MONTH_KEYS) <= set(df.columns) else file_month(df, FACT_TIME[dtype]))
    good = F.concat("year", "month").rlike(r"^\d{4}(0[1-9]|1[0-2])$")
    return rows.withColumns({key: F.when(good, F.col(key)).otherwise(F.lit(bad))
                             for key, bad in BAD_TIME.items()})


def counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """``rows``, counted by month while they pass.

    The observed metric is a histogram of the months as numbers. It holds each month apart
    as long as there are fewer than ``MOST_MONTHS``, and its merges join equal months first.
    """
    seen = Observation()
    month = F.concat("year", "month").cast("double")
    return rows.observe(seen, F.histogram_numeric(month, F.lit(MOST_MONTHS)).alias("months")), seen


def observed(seen: Observation) -> dict[tuple[str, str], int] | None:
    """Rows by month, or nothing if there were too many months to tell."""
    bins = seen.get.get("months") or []
    counts: dict[tuple[str, str], int] = {}
    for one in bins:
        month = f"{round(one['x']):06d}"
        key = month[:4], month[4:]
        counts[key] = counts.get(key, 0) + round(one["y"])
    return counts if len(counts) < MOST_MONTHS else None


def by_month(rows: DataFrame) -> dict[tuple[str, str], int]:
    return {(r["year"], r["month"]): r["n"]
            for r in rows.groupBy(*MONTH_KEYS).agg(F.count(F.lit(1)).alias("n")).collect()}


def stored_counts(spark: SparkSession, root: str, batch: str, schema: T.StructType) -> dict:
    """Rows by month of a written batch. No column is read, so the counts are those of the footers."""
    path = snapshots.batch_dir(root, "batches", batch)
    return by_month(spark.read.schema(T.StructType(schema.fields + _PARTITIONS)).parquet(path))


def write_batch(rows: DataFrame, root: str, base: int, schema: T.StructType) -> tuple[str, list[tuple]]:
    """Write rows to a new batch; its name and the count check of each month.

    The source is read once: it is counted on its way into the write and compared with the
    footers. An executor lost on the way may count rows twice, so a month that differs is
    counted again before it is refused.
    """
    spark = rows.sparkSession
    batch = snapshots.new_batch(base)
    passing, seen = counted(rows.select(*schema.names, *MONTH_KEYS))
    passing.write.partitionBy(*MONTH_KEYS).parquet(snapshots.batch_dir(root, "batches", batch))
    source, target = observed(seen), stored_counts(spark, root, batch, schema)
    if source != target:
        source = by_month(rows)
    return batch, [(y, m, source.get((y, m), 0), target.get((y, m), 0),
                    "OK" if source.get((y, m)) == target.get((y, m)) else "MISMATCH")
                   for y, m in sorted(source | target)]


def publish(df: DataFrame, dtype: str, root: str, files: int | None = None) -> DataFrame:
    """Write a new batch, check its counts, publish the months that agree in one version.

    Returns the check, a row per month. The rows are written once and read once; readers see
    either the version before or the one after. A month with a MISMATCH stays as it was.
    Rows without a readable time go to the month ``BAD_TIME``, next to those of earlier
    publishes. The publish runs when called.
    """
    spark = df.sparkSession
    rows = filed(df, dtype).select(*lake_schema(dtype).names)
    base = snapshots.latest(spark, root)
    rows = rows.sortWithinPartitions(*MONTH_KEYS, *FILE_ORDER[dtype]) if files is None \
        else ranged(rows, FILE_ORDER[dtype], files)
    batch, check = write_batch(rows, root, base, FACTS[dtype])
    good = [snapshots.Entry(y, m, batch, n, 0) for y, m, n, _, status in check if status == "OK"]
    if good:
        bad_time = tuple(BAD_TIME.values())
        snapshots.commit(spark, root, base, good, [e[:2] for e in good if e[:2] != bad_time])
    return check_rows(spark, check)


#: Hours stand for stretches of time when files are dealt out.
_HOUR = 13


def allocated(rows: DataFrame, dtype: str, plan: DataFrame) -> DataFrame:
    """Rows in tasks of their month, as many as ``plan`` (year, month, target_files) gives it.

    Rows of a month are counted by the hour; the running count gives each hour its place among
    the files of its month, and a row falls into the file of its place. So files hold equal
    numbers of rows, cover short stretches of time, and a month, or an hour, of many rows
    splits. Months that the plan lacks get one file.
    """
    hour = F.coalesce(F.substring(FACT_TIME[dtype], 1, _HOUR), F.lit(""))
    keys = [*MONTH_KEYS, "_hour"]
    rows = rows.withColumn("_hour", hour)
    hours = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    first = F.sum("target_files").over(Window.orderBy(*MONTH_KEYS)) - F.col("target_files")
    months = plan.select(*MONTH_KEYS, "target_files", first.cast("int").alias("_first"))
    total = (plan.agg(F.sum("target_files")).first()[0] or 0) + 1
    whole = Window.partitionBy(*MONTH_KEYS)
    before = F.sum("_n").over(whole.orderBy("_hour")) - F.col("_n")
    places = cut_lineage(hours.select("*", before.alias("_before"), F.sum("_n").over(whole).alias("_all"))
                         .join(months, MONTH_KEYS, "left"))
    spread = F.pmod(F.xxhash64(*lake_schema(dtype).names, F.spark_partition_id()), F.col("_n"))
    within = F.floor((F.col("_before") + spread) * F.col("target_files") / F.col("_all"))
    goal = F.coalesce(F.col("_first") + within.cast("int"), F.lit(total - 1))
    return rows.join(places, keys).withColumn("_goal", goal) \
        .repartitionById(total, F.col("_goal")) \
        .sortWithinPartitions(*MONTH_KEYS, *FILE_ORDER[dtype]).drop(
            "_hour", "_n", "_before", "_all", "target_files", "_first", "_goal")


def stored_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, year, month) of the files of the newest version."""
    paths = [e.path(root) for e in snapshots.entries(spark, root) if e.rows != 0]
    if not paths:
        return spark.createDataFrame([], "path string, length long, year string, month string")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet") \
        .option("recursiveFileLookup", "true").load(paths).select("path", "length")
    return listed_partitions(files)


def rewrite(spark: SparkSession, root: str, dtype: str, target_bytes: int = TARGET_FILE_BYTES,
            force: bool = False) -> DataFrame:
    """Compact the months whose files are not as many as their size asks for; the count check.

    A month is taken if it lies in several batches, or has over twice or under half of its
    planned files; all with ``force``. The months are replaced by one new version; the
    ledger of their source files goes with them.
    """
    base = snapshots.latest(spark, root)
    plan = file_plan(stored_files(spark, root), target_bytes)
    live = snapshots.entries(spark, root, base)
    batches = {}
    for entry in live:
        batches[entry[:2]] = batches.get(entry[:2], 0) + 1
    chosen = [r for r in plan.collect() if force or batches.get((r["year"], r["month"]), 0) > 1
              or not r["target_files"] / 2 <= r["files"] <= r["target_files"] * 2]
    if not chosen:
        return no_check(spark)
    picked = {(r["year"], r["month"]) for r in chosen}
    schema = with_source(dtype)
    rows = snapshots.read(spark, root, schema, lambda e: e[:2] in picked, base)
    plan = spark.createDataFrame([(r["year"], r["month"], r["target_files"]) for r in chosen],
                                 "year string, month string, target_files int")
    batch, check = write_batch(allocated(rows, dtype, plan), root, base, schema)
    kept = {e[:2]: 0 for e in live if e[:2] in picked}
    for entry in live:
        if entry[:2] in picked:
            kept[entry[:2]] += entry.files
    ledger = snapshots.sources(spark, root, base).filter(
        F.concat("year", "month").isin([y + m for y, m in picked])).drop("batch")
    write_sources(ledger, root, batch)
    good = [snapshots.Entry(y, m, batch, n, kept[y, m]) for y, m, n, _, s in check if s == "OK"]
    if good:
        snapshots.commit(spark, root, base, good, [e[:2] for e in good])
    return check_rows(spark, check)


def with_source(dtype: str) -> T.StructType:
    """Columns of stored rows, the name of their source file included."""
    return T.StructType(FACTS[dtype].fields + [T.StructField(snapshots.SOURCE_FILE, T.StringType())])


def write_sources(ledger: DataFrame, root: str, batch: str) -> None:
    """Names and lengths of the source files of a batch, by the month their rows are under."""
    ledger.select("name", "length", *MONTH_KEYS).repartition(*MONTH_KEYS).write \
        .partitionBy(*MONTH_KEYS).parquet(snapshots.batch_dir(root, "sources", batch))


def read_typed(spark: SparkSession, root: str, paths: Sequence[str], dtype: str) -> DataFrame:
    """Files of one schema variant under the fact's own types and text partitions."""
    raw = spark.read.option("basePath", root).parquet(*paths)
    return raw.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in FACTS[dtype].fields],
        F.col("year").cast("string").alias("year"),
        F.lpad(F.col("month").cast("string"), 2, "0").alias("month"))


def retype_months(spark: SparkSession, roots: Sequence[str], dtype: str) -> DataFrame:
    """One fact out of drops whose column types differ: each read by itself, retyped, united."""
    typed = [read_typed(spark, root, [root], dtype) for root in roots]
    return reduce(DataFrame.unionByName, typed)


def text_months(spark: SparkSession, root: str) -> list[snapshots.Entry]:
    """Folders of the newest version that still hold a typed column as text, told by footers alone.

    The loop is over folders, each read for its schema only.
    """
    return [entry for entry in snapshots.entries(spark, root) if entry.rows != 0
            and columns_to_retype(spark.read.parquet(entry.path(root)))]


def retype_lake(spark: SparkSession, root: str, dtype: str) -> DataFrame | None:
    """Rewrite the text months of a fact in their types; the count check, or none to do."""
    found = text_months(spark, root)
    if not found:
        return None
    base = snapshots.latest(spark, root)
    typed = [read_typed(spark, root, [e.path(root)], dtype).withColumns(
        {"year": F.lit(e.year), "month": F.lit(e.month)}) for e in found]
    batch, check = write_batch(reduce(DataFrame.unionByName, typed), root, base, FACTS[dtype])
    good = [snapshots.Entry(y, m, batch, n, 0) for y, m, n, _, status in check if status == "OK"]
    months = [e[:2] for e in good]
    # Other folders of these months are typed already and stay as they are.
    other = [e for e in snapshots.entries(spark, root, base) if e[:2] in months and e not in found]
    if good:
        snapshots.commit(spark, root, base, good + other, months)
    return check_rows(spark, check)


def stamp(counts: DataFrame, path: str) -> None:
    """Record source file counts of published months, replacing earlier stamps of them."""
    (counts.select("dtype", *MONTH_KEYS, "raw_count").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("dtype", *MONTH_KEYS).parquet(path))


def stamps(spark: SparkSession, path: str) -> DataFrame:
    """All stamps; none yet is an empty table."""
    return read_or_empty(spark, path, T.StructType([
        T.StructField("raw_count", T.LongType()), T.StructField("dtype", T.StringType()),
        *_PARTITIONS]))


def create_table(spark: SparkSession, name: str, dtype: str, location: str) -> None:
    """A catalog table over a fact with ``day`` as an ordinary column."""
    fields = [*FACTS[dtype].fields, T.StructField("day", T.StringType()), *_PARTITIONS]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"PARTITIONED BY (year, month) LOCATION '{location}'")


def overwrite_month(df: DataFrame, name: str, year: str, month: str) -> None:
    """Replace one month of a catalog table.

    Tables of a v2 catalog take a conditional overwrite, plain ones a static
    partition insert; both leave the other months alone.
    """
    spark = df.sparkSession
    part = (F.col("year") == year) & (F.col("month") == month)
    columns = spark.table(name).columns
    kept = df.filter(part).select(*columns)
    if is_v2(spark, name):
        kept.writeTo(name).overwrite(part)
        return
    kept.drop(*MONTH_KEYS).createOrReplaceTempView("roadpulse_month")
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (year = '{year}', month = '{month}') "
              "SELECT * FROM roadpulse_month")


def is_v2(spark: SparkSession, name: str) -> bool:
    """Whether a table lives in a catalog other than the session's own."""
    parts = name.split(".")
    return len(parts) > 2 and parts[0] != "spark_catalog"


def promote(spark: SparkSession, check: DataFrame, view: str, root: str, dtype: str) -> bool:
    """Point a view at a rebuilt fact only if no partition failed; the old data stay."""
    if not check.filter("status <> 'OK'").isEmpty():
        return False
    columns = ", ".join(FACTS[dtype].names)
    # The folders of one version; their months are text again, which a path would not give.
    parts = [f"SELECT {columns}, '{e.year}' AS year, '{e.month}' AS month FROM parquet.`{e.path(root)}`"
             for e in snapshots.entries(spark, root) if e.rows != 0]
    if not parts:
        return False
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS " + " UNION ALL ".join(parts))
    return True
