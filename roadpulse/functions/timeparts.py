"""Text wall-clock times: buckets, ranges, spines.

Times stay text ``yyyy-MM-dd HH:mm[:ss]``: text order is time order, partition
pruning and Parquet statistics work on it, and no session time zone can shift it.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.schemas import PERIOD_LABELS


def parse_when(text: str) -> datetime:
    try:
        return datetime.fromisoformat(str(text))
    except ValueError as error:
        raise ValueError(f"not a time (YYYY-MM-DD HH:MM[:SS]): {text}") from error


def parse_day(text: str) -> date:
    try:
        return datetime.strptime(str(text).strip(), "%Y-%m-%d").date()
    except ValueError as error:
        raise ValueError(f"not a date (YYYY-MM-DD): {text}") from error


@dataclass(frozen=True)
class TimeRange:
    """A closed range of wall-clock time."""

    start: datetime
    end: datetime

    @classmethod
    def of(cls, start: str, end: str) -> TimeRange:
        return cls(parse_when(start), parse_when(end))

    @classmethod
    def days(cls, first: str, last: str) -> TimeRange:
        return cls(datetime.combine(parse_day(first), datetime.min.time()),
                   datetime.combine(parse_day(last), datetime.max.time()))

    def check(self, max_days: int | None = None) -> TimeRange:
        if self.end < self.start:
            raise ValueError("the range ends before it starts")
        if max_days is not None and (self.end - self.start).days > max_days:
            raise ValueError(f"the range is longer than {max_days} days")
        return self

    @property
    def span_days(self) -> float:
        return max(0.0, (self.end - self.start).total_seconds() / 86400)

    @property
    def span_hours(self) -> float:
        """Hours for a mean: one for an empty range, five minutes at least."""
        hours = (self.end - self.start).total_seconds() / 3600
        return max(hours, 1 / 12) if hours > 0 else 1.0

    def minutes(self) -> tuple[str, str]:
        return self.start.strftime("%Y-%m-%d %H:%M"), self.end.strftime("%Y-%m-%d %H:%M")

    def seconds(self) -> tuple[str, str]:
        return self.start.strftime("%Y-%m-%d %H:%M:%S"), self.end.strftime("%Y-%m-%d %H:%M:%S")

    def padded(self, before: int = 0, after: int = 0) -> TimeRange:
        return TimeRange(self.start - timedelta(days=before), self.end + timedelta(days=after))


def month_in(span: TimeRange, pad_days: int = 1):
    """Whether a (year, month) of text lies in a range padded by some days, as a plain function."""
    wide = span.padded(pad_days, pad_days)
    low, high = (f"{t:%Y%m}" for t in (wide.start, wide.end))
    return lambda year, month: low <= year + month <= high


def in_minutes(column: str, span: TimeRange) -> Column:
    """Closed range at minute precision on a text time."""
    return F.col(column).between(*span.minutes())


def in_seconds(column: str, span: TimeRange) -> Column:
    """Closed range at second precision on a text time."""
    return F.col(column).between(*span.seconds())


def months_of(span: TimeRange, pad_days: int = 1) -> Column:
    """Partition predicate on text ``year``/``month`` for a range padded by some days.

    Only plain comparisons of partition columns, so both the file index and a
    catalog can prune with it.
    """
    wide = span.padded(pad_days, pad_days)
    first, last = wide.start.date(), wide.end.date()
    predicate = None
    for year in range(first.year, last.year + 1):
        low = first.month if year == first.year else 1
        high = last.month if year == last.year else 12
        part = F.col("year") == str(year)
        if (low, high) != (1, 12):
            part = part & F.col("month").isin([f"{month:02d}" for month in range(low, high + 1)])
        predicate = part if predicate is None else predicate | part
    return predicate


def day_of(time: Column) -> Column:
    return F.substring(time, 1, 10)


def hour_of(time: Column) -> Column:
    return F.concat(F.substring(time, 1, 13), F.lit(":00"))


def minute_of(time: Column) -> Column:
    return F.substring(time, 1, 16)


def month_of(time: Column) -> Column:
    return F.substring(time, 1, 7)


def slot_of(time: Column, minutes: int) -> Column:
    """Start ``yyyy-MM-dd HH:mm`` of the slot of some minutes (a divisor of 60)."""
    minute = F.substring(time, 15, 2).try_cast("int")
    return F.concat(F.substring(time, 1, 14),
                    F.lpad((F.floor(minute / minutes) * minutes).cast("string"), 2, "0"))


def wall_seconds(time: Column) -> Column:
    """Seconds of a text time on the wall clock, for differences; null if unreadable."""
    return (F.unix_date(F.substring(time, 1, 10).try_cast("date")).cast("bigint") * 86400
            + F.substring(time, 12, 2).try_cast("int") * 3600
            + F.substring(time, 15, 2).try_cast("int") * 60
            + F.coalesce(F.substring(time, 18, 2).try_cast("int"), F.lit(0)))


def minutes_between(start: Column, end: Column) -> Column:
    return (wall_seconds(end) - wall_seconds(start)) / F.lit(60.0)


def flow_bucket(time: Column, span_days: float, station_chosen: bool) -> Column:
    """Grain of a flow series: day over 14 days, hour over 2 days or without a station."""
    if span_days > 14:
        return day_of(time)
    if span_days > 2 or not station_chosen:
        return hour_of(time)
    return time


def trend_bucket(time: Column, span_days: float) -> Column:
    """Grain of a flow trend: day over 14 days, hour over 2 days, else minute."""
    time = F.translate(time, "T", " ")
    if span_days > 14:
        return day_of(time)
    return hour_of(time) if span_days > 2 else minute_of(time)


def trip_bucket(time: Column, span_days: float) -> Column:
    """Grain of a trip trend: 15 minutes, hour, day or month by span."""
    if span_days <= 0.5:
        return slot_of(time, 15)
    if span_days <= 7:
        return hour_of(time)
    return day_of(time) if span_days <= 90 else month_of(time)


def week_start(day: Column) -> Column:
    """Sunday of the week."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def week_end(day: Column) -> Column:
    """Saturday of the week."""
    return F.date_add(day, 7 - F.dayofweek(day))


def month_start(day: Column) -> Column:
    return F.trunc(day, "month").cast("date")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def strict_date(text: Column) -> Column:
    """A date only from a padded ``yyyy-MM-dd`` that exists."""
    text = F.trim(text)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def date_part(text: Column) -> Column:
    """First ``yyyy-MM-dd`` in a text, blank if none."""
    return F.coalesce(F.regexp_extract(text, r"\d{4}-\d{2}-\d{2}", 0), F.lit(""))


def query_time_display(text: Column) -> Column:
    return F.when(F.coalesce(text, F.lit("")) == "", "--").otherwise(F.translate(text, "-", "/"))


def timestamp_display(text: Column) -> Column:
    """``T`` to space, cut to the minute, slashes; ``--`` for blank."""
    shown = F.translate(F.substring(F.regexp_replace(text, "T", " "), 1, 16), "-", "/")
    return F.when(F.coalesce(text, F.lit("")) == "", "--").otherwise(shown)


def period_label(period: Column, first: Column, last: Column) -> Column:
    """Title of a statistics period and its one or two dates."""
    title = F.lit("統計")
    for name, label in PERIOD_LABELS.items():
        title = F.when(period == name, label).otherwise(title)
    begin = F.date_format(first, "yyyy/MM/dd")
    until = F.date_format(last, "yyyy/MM/dd")
    return F.when(first == last, F.concat(title, F.lit("｜"), begin)).otherwise(
        F.concat(title, F.lit("｜"), begin, F.lit(" ～ "), until))


def day_spine(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day, ``day`` as date."""
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(first.isoformat()).cast("date"), F.lit(last.isoformat()).cast("date"))).alias("day"))


def rolling_days(spark: SparkSession, as_of: date, offset: int, count: int) -> DataFrame:
    """The ``count`` days that end ``offset`` days before ``as_of``."""
    newest = as_of - timedelta(days=offset)
    return day_spine(spark, newest - timedelta(days=count - 1), newest)


def spine_of(df: DataFrame, day: Column) -> DataFrame:
    """Every day between the first and the last day of a DataFrame."""
    bounds = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return bounds.select(F.explode(F.sequence("first", "last")).alias("day"))
