"""Structured Streaming jobs: ingest, publishing of complete days, 15-minute flow windows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadpulse.functions.timeparts import day_of
from roadpulse.operators.quality import expected_files, parsed_names
from roadpulse.plans import convert
from roadpulse.schemas import FACT_TIME, FACTS, MINUTES_PER_FILE, files_per_day
from roadpulse.session import list_dir

# Fixed value: data may arrive until the day falls out of the rolling window
# that ends 5 days back and is 20 days long.
LATENESS = "24 days"


def slots(spark: SparkSession, path: str, dtype: str, files_per_batch: int = 10_000) -> DataFrame:
    """Landed CSV files as a stream, each file once."""
    return (spark.readStream.schema(FACTS[dtype]).option("mode", "PERMISSIVE")
            .option("maxFilesPerTrigger", files_per_batch)
            .option("recursiveFileLookup", "true").csv(path))


def ingest(stream: DataFrame, dtype: str, root: str, checkpoint: str) -> StreamingQuery:
    """Append what has landed since the last run, by day, then stop.

    A batch owns the directories of its number, so a repeated batch replaces
    itself and a day that arrives in many batches loses nothing.
    """
    def store(batch: DataFrame, number: int) -> None:
        (batch.withColumn("day", day_of(F.col(FACT_TIME[dtype])))
         .withColumn("batch", F.lit(number)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch", "day").parquet(root))

    return (stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def ingested(spark: SparkSession, root: str, dtype: str) -> DataFrame:
    """Everything ingested so far."""
    schema = T.StructType(FACTS[dtype].fields + [T.StructField("batch", T.LongType()),
                                                 T.StructField("day", T.StringType())])
    return spark.read.schema(schema).parquet(root)


# Fixed value: the columns under which Spark lists files whole.
LISTED = "path string, modificationTime timestamp, length bigint, content binary"
#: Slots of a day in one state column.
_BITS = 60


def landed_files(spark: SparkSession, path: str, files_per_batch: int = 100_000) -> DataFrame:
    """Landed files as a stream of (path, length), each file once, contents unread.

    Files count however old they are, so that days fetched late are seen too.
    """
    return (spark.readStream.format("binaryFile").schema(LISTED)
            .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch)
            .option("maxFileAge", "36500d").load(path).select("path", "length"))


def day_slots(files: DataFrame, dtype: str) -> DataFrame:
    """(day, slots, expected) of each day of one type, from a stream or a table of (path, length).

    The slots that landed are bits of a few numbers, or-ed together: a name that lands twice
    counts once, and a day's state stays the same few bytes. Empty files, names off the grid of
    slots and impossible days do not count.
    """
    step = MINUTES_PER_FILE[dtype]
    hour, minute = (F.substring("hhmm", at, 2).cast("int") for at in (1, 3))
    named = parsed_names(files).filter(
        (F.col("dtype") == dtype) & F.col("day").isNotNull() & (F.col("length") > 0)
        & F.col("name").endswith("00.csv") & (hour < 24) & (minute < 60) & (minute % step == 0))
    slot = ((hour * 60 + minute) / step).cast("int")
    flag = F.call_function("shiftleft", F.lit(1).cast("bigint"), slot % _BITS)
    words = range(-(-files_per_day(dtype) // _BITS))
    held = named.groupBy("day").agg(*[
        F.bit_or(F.when(F.floor(slot / _BITS) == k, flag)).alias(f"w{k}") for k in words])
    count = sum((F.coalesce(F.bit_count(f"w{k}"), F.lit(0)) for k in words), F.lit(0))
    return held.select("day", count.alias("slots"), expected_files(F.lit(dtype)).alias("expected"))


def publish_complete(spark: SparkSession, landing: str, dtype: str, root: str, checkpoint: str,
                     files_per_batch: int = 100_000) -> StreamingQuery:
    """Publish every day to the lake once all of its slots have landed, then stop.

    Rows stay in the landing folder until then; nothing is stored twice. Days that change are
    looked at again, so a slot that lands a second time, in another folder and longer, takes the
    place of its first rows. The ledger tells what is published, so a repeated batch adds nothing.
    A failed count check fails the run before its batch is marked as done. A file written over in
    its own place is not seen again; :func:`convert.convert_days` takes it.
    """
    def publish(batch: DataFrame, _: int) -> None:
        days = [r["day"] for r in batch.filter("slots = expected").select("day").collect()]
        check = convert.convert_given(spark, landing, root, dtype, days)
        wrong = check.filter("status <> 'OK'").collect()
        if wrong:
            raise RuntimeError(f"count check of {root} failed: {wrong}")

    return (day_slots(landed_files(spark, landing, files_per_batch), dtype).writeStream
            .outputMode("update").foreachBatch(publish)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def windowed_flow(stream: DataFrame, time: str = "ts", value: str = "Volume",
                  lateness: str = LATENESS) -> DataFrame:
    """Volume and rows per 15-minute window and vehicle, complete once the watermark passes."""
    return (stream.withWatermark(time, lateness)
            .groupBy(F.window(time, "15 minutes"), "VehicleType")
            .agg(F.sum(value).alias("volume"), F.count(F.lit(1)).alias("row_count"))
            .select(F.col("window.start").alias("window_start"), "VehicleType", "volume",
                    "row_count"))


def drain(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write finished windows to files, process what is there, then stop."""
    return (windows.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def dropped(query: StreamingQuery) -> int:
    """Rows that came behind the watermark and are in no window, over all batches of a run.

    Their months have to be computed from the lake.
    """
    return sum(int(operator["numRowsDroppedByWatermark"])
               for progress in query.recentProgress for operator in progress["stateOperators"])


#: Microseconds of a window.
_QUARTER = 15 * 60_000_000
_WINDOW = "window_start timestamp, VehicleType int, volume bigint, row_count bigint"


def sealed(spark: SparkSession, root: str, before: int | None = None) -> tuple[int, int] | None:
    """(batch, latest time in it or before, in microseconds) of the newest whole batch."""
    numbers = [int(name[6:]) for name, _ in list_dir(spark, f"{root}/marks")
               if name.startswith("batch=") and (before is None or int(name[6:]) < before)]
    if not numbers:
        return None
    newest = max(numbers)
    return newest, spark.read.schema("seen bigint").parquet(f"{root}/marks/batch={newest}").first()[0]


def split_flow(stream: DataFrame, root: str, checkpoint: str, time: str = "ts", value: str = "Volume",
               lateness: timedelta = timedelta(days=24)) -> StreamingQuery:
    """15-minute sums that lose no row: what comes too late goes to a table of its own, then stop.

    A row is late if its window ended ``lateness`` before the latest time of earlier batches, the
    rule by which :func:`windowed_flow` drops it; a row without a time is late too. Other rows
    are summed by window and vehicle. A batch writes its sums and its late rows to folders
    of its number and its mark last, so a repeated batch replaces itself and readers see
    whole batches only. No state is held between batches but one time. A root belongs to one
    checkpoint.
    """
    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        earlier = sealed(spark, root, number)
        seen = earlier and earlier[1]
        rows = batch.persist()
        # Not F.window, which leaves out rows without a time.
        end = (F.floor(F.unix_micros(F.col(time)) / _QUARTER) + 1) * _QUARTER
        late = F.col(time).isNull()
        if seen is not None:
            late = late | (end <= seen - lateness // timedelta(microseconds=1))
        rows.filter(~late).groupBy(F.window(time, "15 minutes").alias("w"), "VehicleType").agg(
            F.sum(value).cast("bigint").alias("volume"), F.count(F.lit(1)).alias("row_count")).select(
            F.col("w.start").alias("window_start"), "VehicleType", "volume", "row_count").write.mode(
            "overwrite").parquet(f"{root}/windows/batch={number}")
        rows.filter(late).write.mode("overwrite").parquet(f"{root}/late/batch={number}")
        rows.agg(F.greatest(F.max(F.unix_micros(F.col(time))), F.lit(seen).cast("bigint")).alias("seen")
                 ).write.mode("overwrite").parquet(f"{root}/marks/batch={number}")
        rows.unpersist()

    return (stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def finished_windows(spark: SparkSession, root: str, lateness: timedelta = timedelta(days=24)) -> DataFrame:
    """Sums of the windows that get no more rows: those that ended ``lateness`` before the latest time."""
    newest = sealed(spark, root)
    if newest is None or newest[1] is None:
        return spark.createDataFrame([], _WINDOW)
    limit = newest[1] - lateness // timedelta(microseconds=1)
    return (spark.read.schema(_WINDOW + ", batch bigint").parquet(f"{root}/windows")
            .filter(F.col("batch") <= newest[0])
            .groupBy("window_start", "VehicleType").agg(
                F.sum("volume").alias("volume"), F.sum("row_count").alias("row_count"))
            .filter(F.unix_micros("window_start") + _QUARTER <= limit))


def late_rows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Rows that are in no window, with the batch they came in."""
    newest = sealed(spark, root)
    wide = T.StructType(schema.fields + [T.StructField("batch", T.LongType())])
    if newest is None:
        return spark.createDataFrame([], wide)
    return spark.read.schema(wide).parquet(f"{root}/late").filter(F.col("batch") <= newest[0])


def late_months(late: DataFrame, time: str = "ts") -> DataFrame:
    """Months whose windows lack late rows and are to be computed from the lake again; null: no time."""
    return late.groupBy(F.date_format(time, "yyyy").alias("year"), F.date_format(time, "MM").alias("month")
                        ).agg(F.count(F.lit(1)).alias("late"))
