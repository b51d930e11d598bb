"""Schemas, value domains and retype rules of the two facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and types of the stored files, codes, file names.
DETECTIONS = T.StructType([
    T.StructField("TimeInterval", T.StringType()),
    T.StructField("GantryID", T.StringType()),
    T.StructField("Direction", T.StringType()),
    T.StructField("VehicleType", T.IntegerType()),
    T.StructField("Volume", T.IntegerType()),
])
TRIPS = T.StructType([
    T.StructField("VehicleType", T.IntegerType()),
    T.StructField("DetectionTime_O", T.StringType()),
    T.StructField("GantryID_O", T.StringType()),
    T.StructField("DetectionTime_D", T.StringType()),
    T.StructField("GantryID_D", T.StringType()),
    T.StructField("TripLength", T.DoubleType()),
    T.StructField("TripEnd", T.StringType()),
    T.StructField("TripInformation", T.StringType()),
])
RETYPED = {"VehicleType": "int", "TripLength": "double", "Volume": "int"}
VEHICLE_ORDER = [31, 32, 41, 42, 5]
VEHICLE_LABELS = {31: "小客車", 32: "小貨車", 41: "大客車", 42: "大貨車", 5: "聯結車"}
OTHER_VEHICLE = "其他車種"
ALL_VEHICLES = "全部車種"
UNNAMED_VEHICLE = "未分類"
DIRECTIONS = ["N", "S"]
ROAD_DIRECTION_LABELS = {"N": "北上", "S": "南下"}
QUERY_DIRECTION_LABELS = {"N": "北向（N）", "S": "南向（S）"}
ALL_DIRECTIONS = "全部方向"
UNNAMED_SECTION = "未命名路段"
UNNAMED_STATION = "未標示門架"
OTHER_ROADS = "其他道路"
PERIOD_LABELS = {"daily": "日流量", "weekly": "週流量", "monthly": "月流量"}
MINUTES_PER_FILE = {"M06A": 60, "M03A": 5}
FILE_NAME = r"TDCS_(M03A|M06A)_(\d{8})_(\d{6})\.csv$"
STATION_ID = r"^\d{2}[FHA](\d{4})[NS]$"

FACTS = {"M03A": DETECTIONS, "M06A": TRIPS}
FACT_TIME = {"M03A": "TimeInterval", "M06A": "DetectionTime_O"}


def files_per_day(dtype: str) -> int:
    return 24 * 60 // MINUTES_PER_FILE[dtype]


def retype(df: DataFrame, rules: dict[str, str] = RETYPED) -> DataFrame:
    """Bring the columns named in ``rules`` to their type; a bad value becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in rules.items() if c in df.columns})


def columns_to_retype(df: DataFrame, rules: dict[str, str] = RETYPED) -> list[str]:
    """Columns still stored as text although the rules name another type."""
    return [f.name for f in df.schema.fields
            if f.name in rules and isinstance(f.dataType, T.StringType)]


def partition_text(df: DataFrame) -> DataFrame:
    """``year`` as text and ``month`` as two-digit text, so directories keep their padding."""
    return df.withColumns({
        "year": F.col("year").cast("string"),
        "month": F.lpad(F.col("month").cast("string"), 2, "0"),
    })


def file_month(df: DataFrame, time_column: str) -> DataFrame:
    """Add ``year``/``month`` partition text taken from a text time; null if there is no month in it."""
    dated = F.col(time_column).rlike(r"^\d{4}-(0[1-9]|1[0-2])")
    return df.withColumns({
        "year": F.when(dated, F.substring(time_column, 1, 4)),
        "month": F.when(dated, F.substring(time_column, 6, 2)),
    })


def with_day(df: DataFrame, time_column: str) -> DataFrame:
    """Two-digit ``day`` of the event time; the partition stays the filing month."""
    return df.withColumn("day", F.lpad(F.dayofmonth(
        F.col(time_column).try_cast("timestamp_ntz")).cast("string"), 2, "0"))


def vehicle_label(code: Column) -> Column:
    """Label of a vehicle code: blank means all, unknown means other."""
    text = F.trim(code.cast("string"))
    named = F.when(text.isNull() | (text == ""), F.lit(ALL_VEHICLES))
    for value, label in VEHICLE_LABELS.items():
        named = named.when(text == str(value), F.lit(label))
    return named.otherwise(F.lit(OTHER_VEHICLE))


def road_direction_label(direction: Column) -> Column:
    return F.when(direction == "S", ROAD_DIRECTION_LABELS["S"]).otherwise(ROAD_DIRECTION_LABELS["N"])


def query_direction_label(direction: Column) -> Column:
    return (F.when(direction == "N", QUERY_DIRECTION_LABELS["N"])
            .when(direction == "S", QUERY_DIRECTION_LABELS["S"])
            .otherwise(ALL_DIRECTIONS))
