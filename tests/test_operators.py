"""Operators on small literal data: ties, nulls, aliases, validity, gaps."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from roadpulse.functions.timeparts import TimeRange, day_spine, rolling_days
from roadpulse.operators import alias as al
from roadpulse.operators import flow, quality, ranking, routes, stations, stats, trips

SPAN = TimeRange.of("2024-01-01 00:00", "2024-01-02 00:00")


def rows(df, *keys):
    return [tuple(r) for r in (df.orderBy(*keys) if keys else df).collect()]


def facts(spark, *values):
    return spark.createDataFrame(
        list(values), "TimeInterval string, GantryID string, Direction string, VehicleType int, "
                      "Volume int")


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.createDataFrame([
        ("A", False, "", "B"), ("B", False, "A", "C"), ("C", True, "B", ""),
        ("X", False, None, "Y"), ("Y", False, "X", None), ("Q", True, "", ""),
        ("N", True, "", "M"), ("M", True, "N", ""),
    ], "id string, is_active boolean, old_id string, new_id string")


@pytest.fixture(scope="module")
def alias(dimension):
    return al.alias_table(dimension)


def test_alias_groups(alias):
    """Chains are one group, singles are none; in use wins, else the largest id."""
    assert rows(alias.select("id", "component", "canonical", "members"), "id") == [
        ("A", "A", "C", 3), ("B", "A", "C", 3), ("C", "A", "C", 3), ("M", "M", "M", 2),
        ("N", "M", "M", 2), ("X", "X", "Y", 2), ("Y", "X", "Y", 2)]


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = spark.range(1, 300).select(F.format_string("c%05d", "id").alias("id"),
                                       F.format_string("c%05d", F.col("id") - 1).alias("other"))
    hub = spark.range(1, 300).select(F.format_string("h%05d", "id").alias("id"),
                                     F.lit("h99999").alias("other"))
    got = al.components(chain.unionByName(hub))
    assert rows(got.groupBy("component").count(), "component") == [("c00000", 300),
                                                                   ("h00001", 300)]


def test_expansion_order_and_attribution(spark, alias):
    def expand(*ids):
        return sorted((r["id"], r["asked"])
                      for r in al.expansion(alias, al.asked_ids(alias, ids)).collect())
    assert expand("C", "Q") == [("A", "C"), ("B", "C"), ("C", "C"), ("Q", "Q")]
    assert expand("A", "C") == [("A", "A"), ("B", "C"), ("C", "C")]
    assert expand("Q", "Q") == [("Q", "Q")]
    # the last asked id of a group takes its aliases, also if it was asked before
    assert expand("A", "B", "A") == [("A", "A"), ("B", "B"), ("C", "A")]
    assert al.expanded_ids(alias, ["Y"], ["Q", "N"]) == [["Y", "X"], ["Q", "N", "M"]]
    assert al.expanded_ids(None, ["Y", "Y"]) == [["Y"]]


def test_any_number_of_ids(spark, alias):
    """Thousands of ids give what a few give, repeated ones too."""
    data = facts(spark, ("2024-01-01 00:00", "A", "N", 31, 1), ("2024-01-01 00:00", "C", "N", 31, 2),
                 ("2024-01-01 00:00", "Z", "N", 31, 4))
    others = [f"x{n}" for n in range(3000)]
    for more in ([], others):
        got = rows(al.attribute(data, alias, ["A", "B", "A", *more]).select("GantryID", "Volume"))
        assert sorted(got) == [("A", 1), ("A", 2)]
        assert rows(al.attribute(data, None, ["Z", *more]).select("Volume")) == [(4,)]
        assert al.expanded_ids(alias, ["C", *more])[0][:3] == ["C", "A", "B"]


def test_series_across_a_renumbering(spark, alias):
    data = facts(spark, ("2024-01-01 00:00", "A", "N", 31, 1), ("2024-01-01 00:00", "C", "N", 31, 2),
                 ("2024-01-01 00:05", "C", "S", 32, 4), ("2024-01-02 00:05", "C", "N", 31, 8))
    got = flow.series(data, SPAN, ["C"], alias=alias)
    assert rows(got, "time", "direction") == [("2024-01-01 00:00", "C", "N", "31", 3),
                                              ("2024-01-01 00:05", "C", "S", "32", 4)]
    plain = flow.series(data, SPAN, ["C"]).agg(F.sum("traffic_volume")).first()[0]
    assert got.agg(F.sum("traffic_volume")).first()[0] >= plain
    assert rows(flow.series(data, SPAN, ["C"], "S", 32).select("traffic_volume")) == [(4,)]
    assert flow.series(data, SPAN, ["C"], "East").count() == 2


def test_series_without_station_is_hourly(spark):
    data = facts(spark, ("2024-01-01 00:00", "A", "N", 31, 1), ("2024-01-01 00:55", "A", "N", 31, 2))
    assert rows(flow.series(data, SPAN).select("time", "traffic_volume")) == [
        ("2024-01-01 00:00", 3)]


def test_pages_do_not_overlap(spark):
    data = facts(spark, *[("2024-01-01 00:00", "A", "N", v, v) for v in range(10)])
    pages = [rows(flow.detail_page(data, SPAN, 4, at).select("Volume")) for at in (0, 4, 8)]
    assert sorted(sum(pages, [])) == [(v,) for v in range(10)]


def test_metrics_take_the_earliest_peak(spark):
    data = facts(spark, ("2024-01-01 00:05", "A", "N", 31, 3), ("2024-01-01 00:00", "B", "N", 31, 3),
                 ("2024-01-02 00:00", "A", "N", 31, 2)).select(
        F.col("TimeInterval").alias("time"), F.col("GantryID").alias("gantry_id"),
        F.col("Volume").alias("traffic_volume"))
    assert rows(flow.metrics(data)) == [(8, 4.0, 2, "2024-01-01 00:00", 3)]


def test_vehicle_share(spark):
    data = facts(spark, ("2024-01-01 00:00", "A", "N", 31, 3), ("2024-01-01 00:00", "A", "N", 99, 1))
    fine = stats.base(data, TimeRange.days("2024-01-01", "2024-01-01"), hourly=True)
    assert rows(stats.vehicle_share(fine)) == [
        ("31", 3, 75.0), ("32", 0, 0.0), ("41", 0, 0.0), ("42", 0, 0.0), ("5", 0, 0.0)]
    nothing = stats.base(data, TimeRange.days("2023-01-01", "2023-01-01"), hourly=True)
    assert {r[2] for r in rows(stats.vehicle_share(nothing))} == {0.0}
    assert rows(stats.total(nothing)) == [(0, 0)]


GROUP = ("group_id string, current_gantry_id string, gantry_ids array<string>, "
         "display_name string, direction string, road string, lat double, lng double, "
         "versions array<struct<first_seen:string,last_seen:string,is_active:boolean>>")


@pytest.fixture(scope="module")
def groups(spark):
    return stations.normalize_groups(spark.createDataFrame([
        ("g1", "01F0300N", ["01F0300N", "01F0299N"], "three", "N", "R1", 25.0, 121.0,
         [("2024-01-01", "2024-02-01", True)]),
        (None, "01F0200N", None, None, None, "R1", 24.0, 121.0,
         [("2024-01-01", "2024-02-01", False)]),
        ("g3", "01F0100N", [], "one", "N", "R1", 23.0, 121.0, [(None, None, False)]),
        ("g4", "01F0100S", ["01F0100S"], "one back", "S", "R1", 23.0, 121.0, None),
        ("g5", "03F0500N", ["03F0500N"], "far", "N", "", None, None, [(None, None, True)]),
    ], GROUP))


def test_normalized_groups(groups):
    got = {r["group_id"]: r for r in groups.collect()}
    assert got["G_01F0200N"]["name"] == "01F0200N"
    assert got["G_01F0200N"]["gantry_ids"] == ["01F0200N"]
    assert got["G_01F0200N"]["group_direction"] == "N"
    assert got["g4"]["direction_label"] == "南下"
    assert got["g3"]["gantry_ids"] == ["01F0100N"]
    assert [got[g]["km"] for g in ("g1", "g5")] == [30.0, 50.0]


def test_validity(groups):
    def valid(first, last):
        kept = stations.active_sections(groups, first, last)
        return sorted(r["group_id"] for r in kept.collect())
    assert valid(date(2024, 1, 5), date(2024, 1, 6)) == ["G_01F0200N", "g1", "g5"]
    assert valid(date(2024, 3, 1), date(2024, 3, 2)) == ["g1", "g5"]
    assert valid(date(2023, 3, 1), date(2023, 3, 2)) == ["g5"]
    assert valid(date(2023, 3, 1), date(2024, 1, 1)) == ["G_01F0200N", "g1", "g5"]


def test_first_group_wins_a_shared_id(spark, groups):
    twice = groups.unionByName(groups.filter("group_id = 'g1'").withColumn("group_id", F.lit("a0")))
    got = stations.group_lookup(twice).filter("station = '01F0299N'")
    assert rows(got.select("group_id")) == [("a0",)]


def test_section_volume_falls_back(spark, groups, alias):
    data = facts(spark, ("2024-01-01 00:00", "01F0299N", "N", 31, 5),
                 ("2024-01-01 00:00", "OLD", "N", 31, 7), ("2024-01-01 00:00", "NEW", "S", 31, 7))
    renamed = spark.createDataFrame([("OLD", "01F0300N"), ("01F0299N", "01F0100N")],
                                    "id string, canonical string")
    fine = stats.base(data, TimeRange.days("2024-01-01", "2024-01-01"), hourly=False)
    got = stats.road_ranking(fine, stations.with_aliases(stations.group_lookup(groups), renamed))
    assert rows(got.select("group_id", "direction", "volume", "share")) == [
        ("g1", "N", 12, 63.2), ("RAW_NEW", "S", 7, 36.8)]


def test_driving_order_candidates_corridor(spark, groups):
    order = stations.driving_order(groups).filter("group_direction = 'N' and road = 'R1'")
    assert [r["group_id"] for r in order.orderBy("place").collect()] == ["g1", "G_01F0200N", "g3"]
    start = spark.createDataFrame([("G_01F0200N",)], "start_id string")
    assert rows(stations.candidates(groups, start).select("end_id", "other_road"), "end_id") == [
        ("g3", False), ("g5", True)]
    pairs = spark.createDataFrame([("g1", "g3"), ("g1", "g5")], "start_id string, end_id string")
    got = stations.corridor(groups, pairs)
    assert rows(got.select("end_id", "step", "group_id"), "step") == [
        ("g3", 1, "g1"), ("g3", 2, "G_01F0200N"), ("g3", 3, "g3")]


def test_co_located_north_first(groups):
    assert rows(stations.co_located(groups).filter("size > 1").select(
        "group_id", "position"), "position") == [("g3", 1), ("g4", 2)]


def test_pairs(spark, groups):
    pairs = spark.createDataFrame([
        ("01F0300N", "01F0100N", "a", "b"), ("01F0100N", "01F0300N", "a", "b"),
        ("01F0100S", "01F0300S", "a", "b"), ("01F0300S", "01F0100S", "a", "b"),
        ("01F0300N", "01F0100S", "a", "b"), ("01F0300N", "01F0300N", "a", "a"),
        ("01F0100N", "03F0500N", "a", "b"), ("01H0300N", "01H0400N", "a", "b"),
        ("", "01F0100N", "", "b")],
        "start_gantry string, end_gantry string, start_group string, end_group string")
    assert [r["verdict"] for r in stations.pair_validity(pairs).collect()] == [
        "ok", "against the way", "ok", "against the way", "opposite direction", "same section",
        "ok", "against the way", "missing"]
    asked = spark.createDataFrame([("g1", "g3"), ("g3", "g1"), ("g1", "g4"), ("g1", "g1"),
                                   ("g5", "g1")], "first_id string, second_id string")
    got = {(r[0], r[1]): tuple(r[2:]) for r in stations.oriented(groups, asked).collect()}
    assert got == {("g1", "g3"): ("kept", "g1", "g3"), ("g3", "g1"): ("swapped", "g1", "g3"),
                   ("g1", "g4"): ("opposite", "g1", "g4"), ("g1", "g1"): ("same", "g1", "g1"),
                   ("g5", "g1"): ("kept", "g5", "g1")}


def test_routes_to_draw(spark, groups):
    lookup = stations.group_lookup(groups)
    pairs = spark.createDataFrame([
        ("g1", "g3", "01F0300N,01F0299N,01F0100N"), ("g1", "G_01F0200N", None),
        ("g3", "g4", None), ("g1", "g5", "01F0300N,03F0500N")],
        "start_id string, end_id string, route string")
    drawn = routes.drawn_route(pairs, groups, lookup)
    got = {(r[0], r[1]): (r[2], r[3]) for r in drawn.groupBy("start_id", "end_id").agg(
        F.first("source"), F.count("step")).collect()}
    # the repeated place collapses; a pair without any two places is not drawn
    assert got == {("g1", "g3"): ("observed", 2), ("g1", "G_01F0200N"): ("corridor", 2),
                   ("g3", "g4"): ("ends", 2)}


TRIP = ("VehicleType int, DetectionTime_O string, GantryID_O string, DetectionTime_D string, "
        "GantryID_D string, TripLength double, TripEnd string, TripInformation string")


def trip(vehicle, *legs):
    path = "; ".join(f"2024-01-0{day} {time}+{station}" for day, time, station in legs)
    first, last = legs[0], legs[-1]
    return (vehicle, f"2024-01-0{first[0]} {first[1]}", first[2], f"2024-01-0{last[0]} {last[1]}",
            last[2], 1.0, "Y", path)


@pytest.fixture(scope="module")
def driven(spark):
    return spark.createDataFrame([
        trip(31, (1, "08:00:00", "A1"), (1, "08:14:00", "B1")),
        trip(31, (1, "08:14:59", "A1"), (1, "08:20:00", "M1"), (1, "08:29:59", "B1")),
        trip(31, (1, "08:10:00", "A1"), (1, "08:15:00", "M1"), (1, "08:26:00", "B1")),
        trip(5, (1, "23:50:00", "Z1"), (2, "00:05:00", "A1"), (2, "00:25:00", "B1")),
        trip(5, (1, "08:00:00", "B1"), (1, "08:10:00", "A1")),
    ], TRIP)


DAYS = TimeRange.of("2024-01-01 00:00:00", "2024-01-01 23:59:59")
NEXT = TimeRange.of("2024-01-02 00:00:00", "2024-01-02 12:00:00")


def test_travel_time(driven):
    got = trips.travel_time(trips.stretches(driven, DAYS, ["A1"], ["B1"]))
    # 14 + 15 + 16 minutes in one quarter of an hour
    assert rows(got) == [("2024-01-01 08:00", "31", 3, 45 * 60, 15.0)]


def test_time_at_the_start_decides(driven):
    """Departure the day before, start passed inside the range; the detail page goes by departure."""
    got = trips.travel_time(trips.stretches(driven, NEXT, ["A1"], ["B1"]))
    assert rows(got.select("origin_time", "trip_count")) == [("2024-01-02 00:00", 1)]
    assert trips.detail_page(driven, NEXT, ["A1"], ["B1"]).count() == 0
    assert trips.detail_page(driven, DAYS, ["A1"], ["B1"]).count() == 4
    assert trips.detail_page(driven, DAYS, ["A1"], ["B1"], [5]).count() == 1


def test_modal_route_and_ties(spark, driven):
    got = trips.modal_route(driven.filter("VehicleType = 31"), ["A1"], ["B1"])
    assert rows(got) == [("A1,M1,B1", 2)]
    tied = trips.modal_route(driven.limit(2), ["A1"], ["B1"])
    assert rows(tied) == [("A1,B1", 1)]
    assert trips.modal_route(driven, ["M1"], ["A1"]).isEmpty()


def test_trip_metrics(spark):
    data = spark.createDataFrame([
        ("2024-01-01 08:00", "31", 2, 240), ("2024-01-01 09:00", "5", 2, 240),
        ("2024-01-01 09:15", "31", 0, 0)],
        "origin_time string, vehicle_type string, trip_count bigint, sum_seconds bigint")
    span = TimeRange.of("2024-01-01 08:00", "2024-01-01 10:00")
    assert rows(trips.metrics(data, span)) == [(4, 2.0, "2024-01-01 08:00", 2, "31", 2, 50.0)]
    assert rows(trips.mean_travel_minutes(data)) == [(2.0, 4)]
    assert rows(trips.mean_travel_minutes(data.filter("false"))) == [(None, 0)]
    assert rows(trips.pivot(data, span), "bucket")[0] == ("2024-01-01 08:00", 2, 0, 0, 0, 0, 2)


def test_weighted_mean(spark):
    data = spark.createDataFrame([(10.0, 1.0), (20.0, 3.0), (-1.0, 5.0), (None, 9.0),
                                  (float("nan"), 9.0), (float("inf"), 9.0)],
                                 "travel_minutes double, trip_count double")
    assert rows(trips.weighted_mean(data)) == [(17.5,)]


def test_normalized_rows(spark):
    data = spark.createDataFrame([
        ("2024-01-01 08:00:00", "2024-01-01 08:30:00", "", "120", "2"),
        ("2024-01-01 08:00:00", "2024-01-01 08:30:00", "1:30", "", ""),
        ("2024-01-01 08:00:00", "2024-01-01 08:30:00", "x", "", "0"),
        ("2024-01-01 08:00:00", "2024-01-01 07:30:00", "x", "", "-")],
        "origin_time string, destination_time string, travel_time string, "
        "travel_time_seconds string, trip_count string")
    got = trips.normalized(data, "S", "E", "31")
    assert sorted(rows(got.select("start_gantry", "end_gantry", "vehicle_type", "trip_count",
                                  "travel_minutes"))) == [
        ("S", "E", "31", 1.0, 1.5), ("S", "E", "31", 2.0, 2.0)]
    assert trips.looks_like_trips(data) and not flow.looks_like_detections(data.select("origin_time"))
    assert flow.looks_like_detections(data.withColumnRenamed("trip_count", "Volume"))
    numbers = spark.createDataFrame([(1.0e7,), (0.0005,), (-2.0,), (float("inf"),)],
                                    "travel_time double")
    assert rows(trips.normalized(numbers).select("travel_minutes")) == [
        (1.0e7,), (0.0005,), (-2.0,), (None,)]


def test_ranking_helpers(spark):
    data = spark.createDataFrame([("b", 5), ("a", 5), ("c", 0)], "key string, volume bigint")
    top = ranking.numbered_top(ranking.share_of(data, "volume"), [F.desc("volume"), F.asc("key")], 2)
    assert rows(top, "rank") == [("a", 5, 50.0, 1), ("b", 5, 50.0, 2)]
    assert rows(ranking.peak_of(data, "key", "volume")) == [("a", 5)]
    assert rows(ranking.share_of(data.filter("volume = 0"), "volume")) == [("c", 0, 0.0)]


def test_panels_add_up(spark):
    data = facts(spark, *[(f"2024-01-0{d} 0{h}:00", s, "N", v, d + h)
                          for d in (1, 2) for h in (1, 2) for s in ("A", "B") for v in (31, 5)])
    got = stats.panels(stats.base(data, TimeRange.days("2024-01-01", "2024-01-02"), hourly=True))
    sums = {r[0]: r[1:] for r in got.groupBy("panel").agg(
        F.sum("volume"), F.count(F.lit(1))).collect()}
    assert {v[0] for v in sums.values()} == {48}
    assert {k: v[1] for k, v in sums.items()} == {
        "total": 1, "bucket": 4, "day": 2, "vehicle": 2, "station": 2}


def names(spark, dtype, day, count, length=1):
    step = {"M06A": 60, "M03A": 5}[dtype]
    return [(f"/raw/{dtype}/TDCS_{dtype}_{day}_{m * step // 60:02d}{m * step % 60:02d}00.csv", length)
            for m in range(count)]


def test_gaps_and_backfill(spark):
    listing = spark.createDataFrame(
        names(spark, "M06A", "20240101", 24) + names(spark, "M06A", "20240102", 20)
        + names(spark, "M03A", "20240102", 288) + names(spark, "M03A", "20240101", 5, 0)
        + [("/raw/M03A/readme.txt", 9)], "path string, length bigint")
    files = quality.landed(listing)
    days = day_spine(spark, date(2024, 1, 1), date(2024, 1, 2))
    state = {(r["dtype"], str(r["day"])): r["state"]
             for r in quality.completeness(files, days).collect()}
    assert state == {("M06A", "2024-01-01"): "COMPLETE", ("M06A", "2024-01-02"): "PARTIAL",
                     ("M03A", "2024-01-01"): "EMPTY", ("M03A", "2024-01-02"): "COMPLETE"}
    missing = quality.missing_slots(quality.slot_grid(days), files)
    assert missing.count() == 4 + 288
    whole = quality.backfill_plan(missing, 6)
    assert whole.count() == 4 + 288
    plan = sorted(rows(whole.filter("this_run").select("dtype", "name")))
    assert [p[0] for p in plan] == ["M03A"] * 2 + ["M06A"] * 4
    assert plan[0][1] == "TDCS_M03A_20240101_000000.csv"
    assert rows(quality.backfill_totals(missing, 6)) == [(2, 292, 292 * 45 / 3600, 286)]
    assert rows(quality.archive_days(missing, date(2024, 3, 1)).select("dtype", "files")) == [
        ("M03A", 288)]
    assert quality.archive_days(missing, date(2024, 2, 5)).isEmpty()
    ready = quality.ready_days(quality.completeness(files, days),
                               spark.createDataFrame([], "day date"))
    assert rows(ready) == [("M03A", date(2024, 1, 2))]


def test_rolling_window(spark):
    days = [r["day"] for r in rolling_days(spark, date(2024, 1, 30), 5, 20).orderBy("day").collect()]
    assert (days[0], days[-1], len(days)) == (date(2024, 1, 6), date(2024, 1, 25), 20)


def test_reconcile(spark):
    log = spark.createDataFrame([("M03A", "2024-01-01", "a", "saved"),
                                 ("M03A", "2024-01-02", "b", "fail"),
                                 ("M03A", "2024-01-02", "b", "fail"),
                                 ("M03A", "2024-01-03", "c", "source_missing")],
                                "dtype string, day string, file string, status string")
    got = quality.reconcile(log, day_spine(spark, date(2024, 1, 1), date(2024, 1, 4)))
    assert [r["state"] for r in got.orderBy("day").collect()] == [
        "OK", "INCOMPLETE", "NO_SOURCE", "NO_SOURCE"]
    assert rows(quality.failed_files(log)) == [("M03A", "2024-01-02", "b")]


def test_stale_reasons(spark):
    raw = spark.createDataFrame([("M06A", "2024", m, i) for m in ("01", "02", "03", "04")
                                 for i in range(3)], "dtype string, year string, month string, n int")
    manifest = spark.createDataFrame([("M06A", "2024", "01", 3), ("M06A", "2024", "02", 2)],
                                     "dtype string, year string, month string, raw_count int")
    there = raw.filter("month < '04'")
    got = quality.stale_months(raw, manifest, there)
    assert rows(got.select("month", "reason"), "month") == [
        ("02", "changed"), ("03", "no stamp"), ("04", "unpublished")]


def test_state_and_checks(spark):
    log = spark.createDataFrame([(2024, 1, "ERROR", "t1"), (2024, 1, "OK", "t2"),
                                 (2024, 2, "OK", "t1"), (2024, 2, "MISMATCH", "t2")],
                                "year int, month int, status string, timestamp string")
    states = quality.latest_state(log)
    assert rows(states, "month") == [(2024, 1, "OK"), (2024, 2, "MISMATCH")]
    assert rows(quality.resume_months(quality.months_present(log), states)) == [(2024, 2)]
    got = quality.count_check(log, log.filter("month = 1"), ["year", "month"])
    assert rows(got, "month") == [(2024, 1, 2, 2, "OK"), (2024, 2, 2, 0, "MISMATCH")]


def test_file_plan(spark):
    mb = 1024 * 1024
    files = spark.createDataFrame([("2024", "01", 1), ("2024", "02", 200 * mb), ("2024", "03", 320 * mb),
                                   ("2024", "04", 99_999 * mb)],
                                  "year string, month string, length bigint")
    assert [r["target_files"] for r in quality.file_plan(files).orderBy("month").collect()] == [
        1, 2, 2, 781]


def test_compare_keeps_one_sided_keys(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "v string")
    b = spark.createDataFrame([("x",), ("z",)], "v string")
    assert rows(quality.compare_drops(a, b, F.col("v"), "v"), "v") == [
        ("x", 2, 1, 0.5), ("y", 1, None, None), ("z", None, 1, None)]
    assert rows(quality.inside_coverage(
        spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 2)),
                               (date(2024, 5, 1), date(2024, 5, 2))],
                              "start_date date, end_date date"),
        quality.coverage(spark.createDataFrame([("2024", "01"), ("2024", "03")],
                                               "year string, month string"))).select(
        "covered"), "covered") == [(False,), (True,)]
