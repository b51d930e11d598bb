"""The two facts and their dimensions as views over the given tables.

Everything here is a row-wise projection of a table or a grouping of one, so it
grows with the tables and holds no unbounded group:

* a detection is one ``events`` row; ``props.k`` names the station, ``value``
  gives the vehicle count;
* a trip is one ``events`` row too; it enters at that station, ``k`` gives the
  number of stations and ``value`` the seconds between them;
* stations, their sections and renumberings are grouped out of the detections.

Twenty positions, five values of ``k`` each. Even positions run north, odd south.
Position 4 is renumbered on 2024-01-15.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.paths import computed_once
from roadpulse.functions.station_ids import km_post, road_code
from roadpulse.functions.timeparts import TimeRange, day_of, slot_of
from roadpulse.session import fresh_dir

RENUMBERED = "2024-01-15"
POSITIONS = 20
EVENT_VEHICLE = {"view": 31, "click": 32, "purchase": 41, "signup": 42, "error": 5}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def station_at(position: Column, time: Column) -> Column:
    """Station id in use at a position at a text time."""
    road = (F.when(position < 10, "01F").when(position < 16, "03F")
            .when(position < 18, "01H").otherwise("03A"))
    current = F.concat(road, F.lpad((position * 115).cast("string"), 4, "0"),
                       F.when(position % 2 == 0, "N").otherwise("S"))
    return F.when((position == 4) & (time < RENUMBERED), "01F0459N").otherwise(current)


def events(spark: SparkSession, sf_dir: str, span: TimeRange | None) -> DataFrame:
    """Events with their fields; a range, padded by a day, reaches the Parquet scan."""
    rows = table(spark, sf_dir, "events")
    if span is not None:
        wide = span.padded(1, 1)
        rows = rows.filter(F.col("ts").between(
            F.lit(wide.start.isoformat(" ")).cast("timestamp_ntz"),
            F.lit(wide.end.isoformat(" ")).cast("timestamp_ntz")))
    vehicle = F.lit(None).cast("int")
    for name, code in EVENT_VEHICLE.items():
        vehicle = F.when(F.col("event_type") == name, code).otherwise(vehicle)
    k = F.get_json_object("props", "$.k").cast("int")
    return rows.select(
        "event_id", "user_id", "event_type", k.alias("k"),
        F.substring(F.col("ts").cast("string"), 1, 19).alias("t"),
        F.floor(F.col("value")).cast("int").alias("amount"), vehicle.alias("VehicleType"))


def detections(spark: SparkSession, sf_dir: str, span: TimeRange | None = None) -> DataFrame:
    station = station_at(F.floor(F.col("k") / 5).cast("int"), F.col("t"))
    return events(spark, sf_dir, span).withColumn("GantryID", station).select(
        slot_of(F.col("t"), 5).alias("TimeInterval"), "GantryID",
        F.right("GantryID", F.lit(1)).alias("Direction"), "VehicleType",
        F.col("amount").alias("Volume"))


def trips(spark: SparkSession, sf_dir: str, span: TimeRange | None = None) -> DataFrame:
    position = F.floor(F.col("k") / 5).cast("int")
    step = F.when(position % 2 == 0, -2).otherwise(2)
    hop_seconds = 60 + F.col("amount") * 5
    start, second = F.col("t").cast("timestamp_ntz"), F.lit(timedelta(seconds=1))

    def leg(i: Column) -> Column:
        time = F.substring((start + second * (i * hop_seconds)).cast("string"), 1, 19)
        return F.struct(time.alias("time"),
                        station_at(position + step * i, time).alias("station"))

    inside = F.filter(F.sequence(F.lit(0), F.col("k") % 5),
                      lambda i: (position + step * i).between(0, POSITIONS - 1))
    legs = events(spark, sf_dir, span).select(
        "*", computed_once(F.transform(inside, leg)).alias("leg"))
    last = F.element_at("leg", -1)
    return legs.select(
        "VehicleType",
        F.col("t").alias("DetectionTime_O"),
        F.element_at("leg", 1)["station"].alias("GantryID_O"),
        last["time"].alias("DetectionTime_D"),
        last["station"].alias("GantryID_D"),
        ((F.size("leg") - 1) * 23.0).alias("TripLength"),
        F.when(F.size("leg") == F.col("k") % 5 + 1, "Y").otherwise("N").alias("TripEnd"),
        F.array_join(F.transform("leg", lambda x: F.concat(x["time"], F.lit("+"), x["station"])),
                     "; ").alias("TripInformation"))


def station_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per position and station id: first and last day seen, whether still in use."""
    seen = events(spark, sf_dir, None).select(
        F.floor(F.col("k") / 5).cast("int").alias("position"), F.col("t")).withColumn(
        "station", station_at(F.col("position"), F.col("t")))
    return seen.groupBy("position", "station").agg(
        F.min(day_of(F.col("t"))).alias("first_seen"),
        F.max(day_of(F.col("t"))).alias("last_seen")).withColumn(
        "is_active", F.col("station") != "01F0459N")


def station_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renumbering records: id, in use, old id, new id.

    The road stations come from the events. Each supplier is one more station
    that took over from its predecessor, in runs of four; every third run has
    no station in use any more.
    """
    history = station_history(spark, sf_dir)
    road = history.select(
        F.col("station").alias("id"), "is_active",
        F.when((F.col("position") == 4) & F.col("is_active"), "01F0459N").alias("old_id"),
        F.when((F.col("position") == 4) & ~F.col("is_active"), "01F0460N").alias("new_id"))
    key = F.col("s_suppkey")
    name = lambda value: F.concat(F.lit("S"), F.lpad(value.cast("string"), 9, "0"))
    runs = table(spark, sf_dir, "supplier").select(
        name(key).alias("id"),
        ((key % 4 >= 2) & (F.floor(key / 4) % 3 != 0)).alias("is_active"),
        F.when(key % 4 != 0, name(key - 1)).alias("old_id"),
        F.lit(None).cast("string").alias("new_id"))
    return road.unionByName(runs)


def station_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road sections, one per position, with ids, road, coordinates and versions."""
    version = F.struct(
        F.when(F.col("position") != 7, F.col("first_seen")).alias("first_seen"),
        F.when(F.col("position") != 7, F.col("last_seen")).alias("last_seen"),
        (F.col("is_active") & (F.col("position") != 7)).alias("is_active"))
    # a position has at most two ids, so the lists stay that short
    folded = station_history(spark, sf_dir).groupBy("position").agg(
        F.max_by("station", "first_seen").alias("current_gantry_id"),
        F.array_sort(F.collect_set("station")).alias("gantry_ids"),
        F.array_sort(F.collect_set(version)).alias("versions"))
    current = F.col("current_gantry_id")
    direction = F.right(current, F.lit(1))
    return folded.select(
        F.concat(F.lit("G_"), current).alias("group_id"), "current_gantry_id", "gantry_ids",
        F.concat(F.lit("Section "), F.lpad(F.col("position").cast("string"), 2, "0"))
        .alias("display_name"),
        direction.alias("direction"), road_code(current).alias("road"),
        km_post(current).alias("km"),
        F.when(F.col("position") != 18, 25.0 - F.floor(F.col("position") / 2) * 0.125).alias("lat"),
        F.when(F.col("position") != 18, 121.5 - F.floor(F.col("position") / 2) * 0.0625)
        .alias("lng"),
        F.when(F.col("position") != 9, F.col("versions")).alias("versions"))


def raw_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files of both types: one name per slot in which an event falls.

    ``length`` is 0 for a slot whose only content is empty counts.
    """
    seen = events(spark, sf_dir, None)

    def names(dtype: str, minutes: int) -> DataFrame:
        slot = F.translate(slot_of(F.col("t"), minutes) if minutes < 60
                           else F.concat(F.substring("t", 1, 13), F.lit(":00")), "-: ", "")
        return seen.select(
            F.concat(F.lit(f"TDCS_{dtype}_"), F.substring(slot, 1, 8), F.lit("_"),
                     F.substring(slot, 9, 4), F.lit("00.csv")).alias("name"),
            F.col("amount").cast("bigint").alias("bytes"))

    both = names("M03A", 5).unionByName(names("M06A", 60))
    return both.groupBy("name").agg(F.sum("bytes").alias("length")).withColumn(
        "path", F.concat(F.lit("/raw/"), F.substring("name", 6, 4), F.lit("/year="),
                         F.substring("name", 11, 4), F.lit("/month="),
                         F.substring("name", 15, 2), F.lit("/"), F.col("name")))


def landing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of detections with the file they land in: (name, value).

    Files of a day run from half past midnight, so they hold rows of the next day's first half
    hour. Events of a day take turns in its files; most days use two hours of slots only and
    stay incomplete, those divisible by five use all. The time of ``k`` 99 is unreadable.
    """
    rows = events(spark, sf_dir, None)
    day = F.date_format(F.col("t").cast("timestamp_ntz") - F.lit(timedelta(minutes=30)), "yyyyMMdd")
    turn = F.col("event_id") % F.when(F.substring(day, 8, 1).isin("0", "5"), 288).otherwise(24)
    station = station_at(F.floor(F.col("k") / 5).cast("int"), F.col("t"))
    return rows.withColumn("GantryID", station).select(
        F.format_string("TDCS_M03A_%s_%02d%02d00.csv", day, F.floor(turn / 12), turn % 12 * 5).alias("name"),
        F.to_csv(F.struct(
            F.when(F.col("k") == 99, "never").otherwise(slot_of(F.col("t"), 5)), "GantryID",
            F.right("GantryID", F.lit(1)), "VehicleType", "amount")).alias("value"))


def landing_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of trips with the hourly file of their departure: (name, value)."""
    hour = F.translate(F.substring("DetectionTime_O", 1, 13), "- ", "")
    return trips(spark, sf_dir).select(
        F.concat(F.lit("TDCS_M06A_"), F.substring(hour, 1, 8), F.lit("_"), F.substring(hour, 9, 2),
                 F.lit("0000.csv")).alias("name"), F.to_csv(F.struct("*")).alias("value"))


def land(lines: DataFrame, root: str) -> None:
    """Write (name, value) lines to files of these names, as a source would land them."""
    spark = lines.sparkSession
    aside = fresh_dir(spark, "aside")
    lines.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "name").write.partitionBy("name").text(aside)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    system = Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(Path(root))

    def move(path: str) -> None:
        name = path.rsplit("/name=", 1)[1].split("/")[0]
        system.rename(Path(path), Path(root, name))

    written = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(aside)
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, [r["path"] for r in written.select("path").collect()]))


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fetch attempt per event: file of its slot, outcome from ``k``."""
    k = F.col("k")
    slot = F.translate(slot_of(F.col("t"), 5), "-: ", "")
    return events(spark, sf_dir, None).select(
        F.lit("M03A").alias("dtype"), day_of(F.col("t")).alias("day"),
        F.concat(F.lit("TDCS_M03A_"), F.substring(slot, 1, 8), F.lit("_"),
                 F.substring(slot, 9, 4), F.lit("00.csv")).alias("file"),
        F.when(k < 70, "saved").when(k < 80, "skipped_exist").when(k < 90, "source_missing")
        .otherwise("fail").alias("status"))


def job_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job log of month partitions, one record per order, in key order."""
    return table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
        F.when(F.col("o_orderstatus") == "F", "OK").when(F.col("o_orderstatus") == "O", "MISMATCH")
        .otherwise("ERROR").alias("status"),
        F.concat(F.substring(F.col("o_orderdate").cast("string"), 1, 10), F.lit("T"),
                 F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("timestamp"))


def landed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw listing over many months: one landed file per order."""
    return table(spark, sf_dir, "orders").select(
        F.lit("M06A").alias("dtype"), F.substring(F.col("o_orderdate").cast("string"), 1, 4).alias("year"),
        F.substring(F.col("o_orderdate").cast("string"), 6, 2).alias("month"),
        F.col("o_orderkey").cast("string").alias("name"))


def order_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts stamped at an earlier publish of :func:`landed_orders`.

    December is unpublished, months divisible by 5 carry no stamp, odd months
    were stamped before the orders of status P landed.
    """
    month = F.month("o_orderdate")
    counted = F.when((month % 2 == 0) | (F.col("o_orderstatus") != "P"), 1)
    return (table(spark, sf_dir, "orders").filter(month != 12)
            .groupBy(F.substring(F.col("o_orderdate").cast("string"), 1, 4).alias("year"),
                     F.substring(F.col("o_orderdate").cast("string"), 6, 2).alias("month"))
            .agg(F.count(counted).alias("n"))
            .select(F.lit("M06A").alias("dtype"), "year", "month",
                    F.when(F.col("month").cast("int") % 5 != 0, F.col("n")).alias("raw_count")))
