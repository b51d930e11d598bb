"""Column functions on literals."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from roadpulse import schemas
from roadpulse.functions import paths, station_ids, text
from roadpulse.functions import timeparts as tp
from roadpulse.functions.timeparts import TimeRange
from roadpulse.plans.service import week_of


def column(spark, values, expression, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type_}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_number_value(spark):
    got = column(spark, ["1,234", " 12.5 ", "abc", "", None, "-3", "1e3", "12d", "1e999"],
                 text.number_value)
    assert got == [1234.0, 12.5, 0.0, 0.0, 0.0, -3.0, 1000.0, 0.0, 0.0]


def test_duration_minutes(spark):
    got = column(spark, ["1:02:30", "3:30", "7", "7.5", "junk", "", None, "1:2", "100:00", "-1"],
                 text.duration_minutes)
    assert got == [62.5, 3.5, 7.0, 7.5, None, None, None, None, 100.0, None]


def test_first_filled(spark):
    df = spark.createDataFrame([("", "b"), (None, "c"), ("a", "d")], "time string, ts string")
    assert [r[0] for r in df.select(text.first_filled(df, ["none", "time", "ts"])).collect()] == [
        "b", "c", "a"]
    assert df.select(text.first_filled(df, ["none"])).first()[0] == ""


def test_slots(spark):
    times = ["2024-01-01 08:14:59", "2024-01-01 08:15:00", "2024-01-01 23:59:59"]
    assert column(spark, times, lambda c: tp.slot_of(c, 15)) == [
        "2024-01-01 08:00", "2024-01-01 08:15", "2024-01-01 23:45"]
    assert column(spark, times, lambda c: tp.slot_of(c, 5))[0] == "2024-01-01 08:10"


def test_bucket_limits(spark):
    time = ["2024-01-01 08:14"]
    at = lambda span, chosen: column(
        spark, time, lambda c: tp.flow_bucket(c, span, chosen))[0]
    assert at(2.0, True) == "2024-01-01 08:14"
    assert at(2.001, True) == at(14.0, True) == at(0.1, False) == "2024-01-01 08:00"
    assert at(14.001, True) == at(14.001, False) == "2024-01-01"
    trip = lambda span: column(spark, time, lambda c: tp.trip_bucket(c, span))[0]
    assert [trip(s) for s in (0.5, 0.51, 7.0, 7.01, 90.0, 90.1)] == [
        "2024-01-01 08:00", "2024-01-01 08:00", "2024-01-01 08:00", "2024-01-01", "2024-01-01",
        "2024-01"]
    assert column(spark, ["2024-01-01 08:44"], lambda c: tp.trip_bucket(c, 0.5)) == [
        "2024-01-01 08:30"]
    assert column(spark, ["2024-01-01T08:44:10"], lambda c: tp.trend_bucket(c, 1)) == [
        "2024-01-01 08:44"]


def test_wall_clock_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # that night the clocks there jump from 02:00 to 03:00
        got = column(spark, ["2024-03-10 03:30:00"],
                     lambda c: tp.minutes_between(F.lit("2024-03-10 01:30:00"), c))
        assert got == [120.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_weeks_and_months(spark):
    days = [date(2024, 1, 6), date(2024, 1, 7), date(2024, 2, 29)]
    assert column(spark, days, tp.week_start, "date") == [
        date(2023, 12, 31), date(2024, 1, 7), date(2024, 2, 25)]
    assert column(spark, days, tp.week_end, "date") == [
        date(2024, 1, 6), date(2024, 1, 13), date(2024, 3, 2)]
    assert column(spark, days, tp.month_end, "date")[2] == date(2024, 2, 29)
    assert week_of("2024-01-07") == (date(2024, 1, 7), date(2024, 1, 13))
    assert week_of("2024-01-06") == (date(2023, 12, 31), date(2024, 1, 6))


def test_strict_date_and_displays(spark):
    assert column(spark, [" 2024-02-29", "2023-02-29", "2024-2-1", None], tp.strict_date) == [
        date(2024, 2, 29), None, None, None]
    assert column(spark, ["at 2024-01-02T03", "none", None], tp.date_part) == [
        "2024-01-02", "", ""]
    assert column(spark, ["2024-01-02T03:04:05", "", None], tp.timestamp_display) == [
        "2024/01/02 03:04", "--", "--"]
    assert column(spark, ["2024-01-02 03:04", ""], tp.query_time_display) == [
        "2024/01/02 03:04", "--"]


def test_ranges():
    with pytest.raises(ValueError):
        TimeRange.of("2024-01-02 00:00", "2024-01-01 00:00").check()
    with pytest.raises(ValueError):
        TimeRange.of("2024-01-01 00:00", "2025-01-03 00:00").check(366)
    TimeRange.of("2024-01-01 00:00", "2025-01-01 23:59").check(366)
    with pytest.raises(ValueError):
        TimeRange.of("yesterday", "2024-01-01")
    assert TimeRange.of("2024-01-01 00:00", "2024-01-01 00:00").span_hours == 1
    assert TimeRange.of("2024-01-01 00:00", "2024-01-01 00:01").span_hours == 1 / 12


def test_station_ids(spark):
    ids = ["01F0339N", "01H0271S", "03A0015N", "01F339N", "XXF0339N"]
    assert column(spark, ids, station_ids.km_post) == [33.9, 27.1, 1.5, None, None]
    assert column(spark, ids, station_ids.direction_suffix) == ["N", "S", "N", "N", "N"]


def test_labels(spark):
    assert column(spark, ["31", "5", "99", "", None], schemas.vehicle_label) == [
        "小客車", "聯結車", "其他車種", "全部車種", "全部車種"]
    assert column(spark, ["N", "S", ""], schemas.query_direction_label) == [
        "北向（N）", "南向（S）", "全部方向"]


def path_of(*legs):
    return "; ".join(f"2024-01-01 {time}+{station}" for time, station in legs)


AB = path_of(("08:00:00", "01F0100N"), ("08:05:00", "01F0050N"), ("08:10:00", "01F0010N"))
BA = path_of(("08:00:00", "01F0010N"), ("08:10:00", "01F0100N"))
LOOP = path_of(("08:00:00", "01F0100N"), ("08:10:00", "01F0010N"), ("08:20:00", "01F0100N"),
               ("08:30:00", "01F0010N"), ("08:40:00", "01F0005N"))
A, B = ["01F0100N"], ["01F0010N"]


def test_order_on_the_path(spark):
    values = [AB, BA, LOOP, "", None]
    assert column(spark, values, lambda c: paths.passes_in_order(c, A, B)) == [
        True, False, True, False, None]

    def times(c):
        return F.concat_ws("|", *paths.stretch_times(paths.stretch(c, A, B)))
    assert column(spark, values, times)[:3] == [
        "2024-01-01 08:00:00|2024-01-01 08:10:00", "|", "2024-01-01 08:00:00|2024-01-01 08:30:00"]
    routes = column(spark, values,
                    lambda c: paths.route_between(paths.station_ids(c), A, B))
    assert routes == [["01F0100N", "01F0050N", "01F0010N"], None,
                      ["01F0100N", "01F0010N", "01F0100N", "01F0010N"], None, None]


def test_same_start_and_end_needs_two_passes(spark):
    both = lambda c: F.array_join(paths.route_between(paths.station_ids(c), A, A), ",")
    assert column(spark, [AB, LOOP], both) == [None, "01F0100N,01F0010N,01F0100N"]
    assert column(spark, [AB, LOOP], lambda c: paths.stretch(c, A, A) != "") == [False, True]
    assert column(spark, [AB, LOOP], lambda c: paths.passes_in_order(c, A, A)) == [False, True]


def test_regex_and_legs_agree(spark):
    """The text pattern and the leg positions find the same trips."""
    df = spark.createDataFrame([(v,) for v in (AB, BA, LOOP)], "x string")
    bad = df.filter(paths.passes_in_order(F.col("x"), A, B)
                    != paths.route_between(paths.station_ids(F.col("x")), A, B).isNotNull())
    assert bad.isEmpty()


def test_legs_and_repeats(spark):
    assert [tuple(leg) for leg in column(spark, [BA], paths.legs)[0]] == [
        ("2024-01-01 08:00:00", "01F0010N"), ("2024-01-01 08:10:00", "01F0100N")]
    assert column(spark, [["a", "a", "b", None, None, "a"]], paths.without_repeats,
                  "array<string>") == [["a", "b", None, "a"]]


def test_ids_are_quoted(spark):
    assert column(spark, ["2024-01-01 08:00:00+A.B; 2024-01-01 08:10:00+C", "AxB then C"],
                  lambda c: paths.passes_in_order(c, ["A.B"], ["C"])) == [True, False]


def test_hms_and_grouping(spark):
    assert column(spark, [0, 61, 3725], text.hms, "bigint") == [
        "00:00:00.00", "00:01:01.00", "01:02:05.00"]
    assert column(spark, [1234567], text.grouped, "bigint") == ["1,234,567"]
    assert column(spark, [12.345], lambda c: text.grouped(c, 1), "double") == ["12.3"]
