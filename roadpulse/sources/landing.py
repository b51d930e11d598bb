"""What the source lands: CSV slots, daily archives, file listings, state logs."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.schemas import FACTS

LINES_PER_BATCH = 10_000
STRICT_TIME = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}(:\d{1,2})?$"
STATE_SCHEMA = ("year int, month int, status string, src_count bigint, dst_count bigint, "
                "dst_files int, timestamp string, _broken string")


def csv_slots(spark: SparkSession, path: str, dtype: str) -> DataFrame:
    """Headerless CSV under the fixed schema; a bad field becomes null, the row stays."""
    return spark.read.schema(FACTS[dtype]).option("mode", "PERMISSIVE").csv(path)


def _strict(lines: DataFrame) -> DataFrame:
    """Five trimmed fields with a readable time and a whole volume, or no row."""
    part = F.transform(F.split(F.regexp_replace("value", "^\\uFEFF", ""), ","), lambda x: F.trim(
        F.regexp_replace(F.trim(x), '^"(.*)"$', "$1")))
    time = F.when(F.col("part")[0].rlike(STRICT_TIME), F.col("part")[0].try_cast("timestamp_ntz"))
    return (lines.withColumn("part", part).filter(F.size("part") == 5)
            .select(F.substring(time.cast("string"), 1, 19).alias("time"),
                    F.col("part")[1].alias("gantry_id"), F.col("part")[2].alias("direction"),
                    F.col("part")[3].alias("vehicle_type"),
                    F.when(F.col("part")[4].rlike(r"^[+-]?\d+$"),
                           F.col("part")[4].try_cast("bigint")).alias("traffic_volume"))
            .filter(F.col("time").isNotNull() & F.col("traffic_volume").isNotNull()))


def strict_csv(spark: SparkSession, path: str) -> DataFrame:
    """Detections with broken rows left out and the time normalised to seconds."""
    return _strict(spark.read.text(path))


def listing(spark: SparkSession, root: str, uri: bool = False, names: str = "*") -> DataFrame:
    """Files below a folder as ``(path, length)``, contents unread; empty files are left out.

    With ``uri`` paths are spelled as in the metadata of rows read from them; ``names`` is a
    pattern that file names must match.

    A missing folder is an empty listing; any other failure stays an error, so
    it cannot look as if all files were missing.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
            .option("pathGlobFilter", names).load(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length bigint")
    return files.select(F.col("_metadata.file_path").alias("path") if uri else "path", "length")


def partition_of(path: Column, key: str) -> Column:
    """Value of a ``key=value`` directory in a path, null if there is none."""
    return F.nullif(F.regexp_extract(path, rf"/{key}=([^/]+)/", 1), F.lit(""))


def listed_partitions(files: DataFrame, keys: tuple[str, ...] = ("year", "month")) -> DataFrame:
    return files.withColumns({key: partition_of(F.col("path"), key) for key in keys})


def archives(spark: SparkSession, path: str) -> DataFrame:
    """Daily archives as ``(path, content)``; one archive per task."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def archive_lines(packed: DataFrame) -> DataFrame:
    """Lines of the CSV members of gzipped tar archives, at any depth.

    A broken archive, or one without a CSV, gives one row with a null member.
    """
    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                yield from _members(path, content)

    return packed.mapInPandas(unpack, "archive string, member string, line string")


def _members(path: str, content: bytes) -> Iterator[pd.DataFrame]:
    seen = False
    try:
        with tarfile.open(fileobj=io.BytesIO(content), mode="r:gz") as tar:
            for member in tar:
                if not member.isfile() or not member.name.endswith(".csv"):
                    continue
                seen = True
                name = member.name.rsplit("/", 1)[-1]
                lines = []
                for line in io.TextIOWrapper(tar.extractfile(member), "utf-8-sig"):
                    lines.append(line.rstrip("\r\n"))
                    if len(lines) == LINES_PER_BATCH:
                        yield pd.DataFrame({"archive": path, "member": name, "line": lines})
                        lines = []
                if lines:
                    yield pd.DataFrame({"archive": path, "member": name, "line": lines})
    except (tarfile.TarError, OSError, EOFError, UnicodeDecodeError):
        seen = False
    if not seen:
        yield pd.DataFrame({"archive": [path], "member": [None], "line": [None]})


def archive_state(lines: DataFrame) -> DataFrame:
    """Per archive: CSV members and lines; an archive with a null member is bad."""
    per_member = lines.groupBy("archive", "member").agg(F.count("line").alias("n"))
    return per_member.groupBy("archive").agg(
        F.count("member").alias("members"), F.sum("n").alias("lines"),
        F.max(F.col("member").isNull()).alias("bad"))


def parsed_lines(lines: DataFrame, dtype: str) -> DataFrame:
    """Fact rows of CSV lines, same tolerance as :func:`csv_slots`."""
    schema = FACTS[dtype]
    parsed = F.from_csv("line", schema.simpleString()[7:-1].replace(":", " "))
    return lines.filter(F.col("line").isNotNull()).select(parsed.alias("row")).select("row.*")


def state_log(spark: SparkSession, path: str) -> DataFrame:
    """Job records as JSON lines; broken lines and those without a key are left out."""
    rows = (spark.read.schema(STATE_SCHEMA).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_broken").json(path))
    return rows.filter(F.col("_broken").isNull() & F.col("year").isNotNull()
                       & F.col("month").isNotNull() & F.col("status").isNotNull()).drop("_broken")


def append_state(results: DataFrame, path: str) -> None:
    results.write.mode("append").json(path)


def station_dimension(spark: SparkSession, path: str) -> DataFrame:
    """Renumbering records by column position: 0 id, 6 in use, 7 old id, 8 new id."""
    raw = spark.read.option("header", True).csv(path)
    at = lambda i: F.coalesce(F.trim(F.col(f"`{raw.columns[i]}`")), F.lit(""))
    return raw.select(at(0).alias("id"), (at(6) == "True").alias("is_active"),
                      at(7).alias("old_id"), at(8).alias("new_id")).filter("id <> ''")


def station_groups(spark: SparkSession, path: str) -> DataFrame:
    """Section records of a JSON array file, as read."""
    return spark.read.option("multiLine", True).json(path)


def json_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON object, dates in ISO form."""
    return df.select(F.to_json(F.struct("*"), {
        "dateFormat": "yyyy-MM-dd", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss", "ignoreNullFields": "false",
    }).alias("json"))


