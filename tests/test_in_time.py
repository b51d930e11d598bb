"""Sections that change over time, and days that complete over several stream runs."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import stations, stats
from roadpulse.plans import convert
from roadpulse.session import fresh_dir
from roadpulse.sources import lake, snapshots
from roadpulse.streaming import jobs

GROUP = ("group_id string, current_gantry_id string, gantry_ids array<string>, road string, "
         "versions array<struct<first_seen:string,last_seen:string,is_active:boolean>>")
SECTIONS = [
    # One station in two sections, one after the other, and in a third over both.
    ("b", "01F0300N", ["01F0300N"], "R", [("2024-01-01", "2024-01-10", False)]),
    ("c", "01F0200N", ["01F0200N", "01F0300N"], "R", [("2024-01-11", None, True)]),
    ("a", "01F0300N", [], "R", [("2024-01-05", "2024-01-07", False), ("2024-01-07", "2024-01-08", False)]),
    # Used till a day, begun unknown; never valid; no versions; over before it began.
    ("d", "01F0100N", [], "R", [(None, "2024-01-03", False)]),
    ("e", "01F0090N", [], "R", [(None, None, False)]),
    ("f", "01F0080N", [], "R", None),
    ("g", "01F0070N", [], "R", [("2024-02-01", "2024-01-01", False)]),
    ("h", "01F0060N", [], "R", [("", "", True)]),
]


def found(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def groups(spark):
    return stations.normalize_groups(spark.createDataFrame(SECTIONS, GROUP))


def holder(station, day):
    """The section of a station on a day, by looking at every version."""
    best = None
    for group, current, ids, _, versions in SECTIONS:
        if station != current and station not in ids:
            continue
        for begin, end, active in versions or []:
            if not (active or begin or end):
                continue
            if (begin or "0001-01-01") <= day <= ("9999-12-31" if active else end or "9999-12-31"):
                best = group if best is None else min(best, group)
    return best


def test_spans_are_disjoint_and_whole(groups):
    spans = found(stations.section_spans(groups), "station", "begin", "end", "group_id")
    assert [s[1:] for s in spans if s[0] == "01F0300N"] == [
        ("2024-01-01", "2024-01-04", "b"), ("2024-01-05", "2024-01-08", "a"),
        ("2024-01-09", "2024-01-10", "b"), ("2024-01-11", "9999-12-31", "c")]
    assert [s[1:] for s in spans if s[0] == "01F0100N"] == [("0001-01-01", "2024-01-03", "d")]
    assert {s[0] for s in spans} == {"01F0300N", "01F0200N", "01F0100N", "01F0060N"}


def test_rows_take_the_section_of_their_day(spark, groups):
    days = [f"2024-01-{d:02d}" for d in range(1, 15)] + ["0001-01-01", "9999-12-31"]
    asked = [(s, d) for s in ("01F0300N", "01F0200N", "01F0100N", "01F0090N", "01F0080N",
                              "01F0070N", "01F0060N", "other") for d in days]
    rows = stations.in_section(spark.createDataFrame(asked, "GantryID string, day string"),
                               stations.section_spans(groups))
    got = {(r["GantryID"], r["day"]): r["section"] and r["section"]["group_id"]
           for r in rows.collect()}
    assert rows.count() == len(asked)
    assert got == {(s, d): holder(s, d) for s, d in asked}


def test_volume_in_time(spark, groups):
    fine = spark.createDataFrame([("01F0300N", "2024-01-01 00:00", 1), ("01F0300N", "2024-01-06 00:00", 2),
                                  ("01F0300N", "2024-01-12 00:00", 4), ("01F0200N", "2024-01-12 00:00", 8),
                                  ("01F0200N", "2024-01-02 00:00", 16), (None, "2024-01-02", 32)],
                                 "GantryID string, bucket string, volume long")
    got = stats.section_volume_in_time(fine, stations.section_spans(groups))
    assert sorted(tuple(r) for r in got.select("group_id", "volume").na.fill("").collect()) == [
        ("", 32), ("RAW_01F0200N", 16), ("a", 2), ("b", 1), ("c", 12)]
    empty = stats.section_volume_in_time(fine.limit(0), stations.section_spans(groups.limit(0)))
    assert empty.isEmpty()


def test_candidates_of_days(spark, groups):
    starts = spark.createDataFrame([("c",), ("b",)], "start_id string")
    all_ends = found(stations.candidates(groups, starts), "start_id", "end_id")
    assert ("c", "e") in all_ends and ("c", "g") in all_ends
    days = (date(2024, 1, 12), date(2024, 1, 13))
    assert found(stations.candidates(groups, starts, days), "start_id", "end_id") == [("c", "h")]
    assert stations.candidates(groups, starts, (date(2023, 1, 1), date(2023, 1, 2))).filter(
        "end_id = 'c'").isEmpty()


def put(path, name, text):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(text, encoding="utf-8")


def trip_file(folder, day, hour, rows=1):
    stamp = f"{day} {hour:02d}:00:00"
    put(folder, f"TDCS_M06A_{day.replace('-', '')}_{hour:02d}0000.csv",
        f"31,{stamp},A,{stamp},B,1.5,Y,p\n" * rows)


def test_day_slots(spark):
    names = [f"TDCS_M03A_20240101_{m // 60:02d}{m % 60:02d}00.csv" for m in range(0, 1440, 5)]
    odd = ["TDCS_M03A_20240102_000300.csv", "TDCS_M03A_20240102_240000.csv", "TDCS_M03A_20240102_006000.csv",
           "TDCS_M03A_20240230_000000.csv", "TDCS_M03A_20240102_000007.csv", "TDCS_M06A_20240102_000000.csv",
           "other.csv"]
    files = [(f"/x/{n}", 5) for n in names] + [(f"/again/{n}", 7) for n in names[:9]] \
        + [(f"/x/{n}", 5) for n in odd] + [("/x/TDCS_M03A_20240103_000000.csv", 0),
                                          ("/x/TDCS_M03A_20240102_235500.csv", 1)]
    given = spark.createDataFrame(files, "path string, length long")
    assert found(jobs.day_slots(given, "M03A"), "day", "slots", "expected") == [
        (date(2024, 1, 1), 288, 288), (date(2024, 1, 2), 1, 288)]
    assert found(jobs.day_slots(given, "M06A"), "day", "slots", "expected") == [(date(2024, 1, 2), 1, 24)]
    assert jobs.day_slots(given.limit(0), "M03A").isEmpty()


def test_days_are_published_once_complete(spark, tmp_path):
    raw, root, checkpoint = tmp_path / "raw", fresh_dir(spark, "lake"), fresh_dir(spark, "stream")

    def run(where=checkpoint, per_batch=100_000):
        jobs.publish_complete(spark, str(raw), "M06A", root, where, per_batch).awaitTermination()
        return found(lake.tree(spark, root, "M06A").groupBy(
            F.substring("DetectionTime_O", 1, 10).alias("day")).count(), "day", "count")

    for hour in range(24):
        trip_file(raw, "2024-01-31", hour)
        if hour != 7:
            trip_file(raw / "next", "2024-02-01", hour)
    assert run(per_batch=20) == [("2024-01-31", 24)]
    version = snapshots.latest(spark, root)
    assert run() == [("2024-01-31", 24)] and snapshots.latest(spark, root) == version
    trip_file(raw, "2024-02-01", 7, rows=3)
    both = [("2024-01-31", 24), ("2024-02-01", 26)]
    assert run() == both
    # The work of a lost checkpoint is done again and adds nothing.
    version = snapshots.latest(spark, root)
    assert run(fresh_dir(spark, "stream")) == both and snapshots.latest(spark, root) == version
    # One slot again, longer, in another folder: it takes the place of its rows.
    trip_file(raw / "again", "2024-01-31", 3, rows=2)
    assert run() == [("2024-01-31", 25), ("2024-02-01", 26)]


def test_a_failed_check_is_done_again(spark, tmp_path, monkeypatch):
    raw, root, checkpoint = tmp_path / "raw", fresh_dir(spark, "lake"), fresh_dir(spark, "stream")
    for hour in range(24):
        trip_file(raw, "2024-01-31", hour)
    right = convert.convert_given
    monkeypatch.setattr(convert, "convert_given", lambda *a: lake.check_rows(
        spark, [("2024", "01", 24, 23, "MISMATCH")]))
    with pytest.raises(Exception, match="MISMATCH"):
        jobs.publish_complete(spark, str(raw), "M06A", root, checkpoint).awaitTermination()
    monkeypatch.setattr(convert, "convert_given", right)
    jobs.publish_complete(spark, str(raw), "M06A", root, checkpoint).awaitTermination()
    assert lake.tree(spark, root, "M06A").count() == 24
    assert convert.convert_given(spark, str(raw), root, "M06A", []).isEmpty()


FLOW = "ts timestamp, VehicleType int, Volume int"


def test_no_row_is_lost_behind_the_watermark(spark, tmp_path):
    """Each batch as Spark's own watermark sees it: the same windows, the same rows left out."""
    source, root = str(tmp_path / "src"), fresh_dir(spark, "windows")
    marks, own, out = (fresh_dir(spark, "stream") for _ in range(3))
    batches = [
        [("2024-01-01 00:01:00", 31, 1), ("2024-01-01 00:10:00", 31, 2), ("2024-01-20 00:00:00", 5, 4)],
        [("2024-01-01 00:14:59", 31, 8), ("2024-01-26 00:00:00", 31, 16)],
        # On time by 15 minutes, late, late.
        [("2024-01-02 00:00:00", 31, 32), ("2024-01-01 00:02:00", 31, 64), ("2023-12-01 00:00:00", None, 128)],
        [("2024-01-01 23:59:59", 31, 256), ("2024-02-20 00:00:00", 31, 512)],
        [("2024-01-20 00:00:00", 5, 1024)]]
    dropped = 0
    for values in batches:
        spark.createDataFrame(values, "ts string, VehicleType int, Volume int").withColumn(
            "ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(FLOW).parquet(source)
        jobs.split_flow(stream, root, marks).awaitTermination()
        query = jobs.drain(jobs.windowed_flow(stream), out, own)
        query.awaitTermination()
        dropped += jobs.dropped(query)
    names = ["window_start", "VehicleType", "volume", "row_count"]
    spark_own = spark.read.schema(jobs._WINDOW).parquet(out)
    windows = jobs.finished_windows(spark, root)
    late = jobs.late_rows(spark, root, spark.read.schema(FLOW).parquet(source).schema)
    assert found(windows, *names) == found(spark_own, *names) != []
    # Spark counts late rows after it has combined them within a task.
    assert late.count() >= dropped > 0
    sums = [tuple(r) for r in windows.agg(F.sum("volume"), F.sum("row_count")).collect()]
    rest = spark.read.schema(jobs._WINDOW).parquet(f"{root}/windows").agg(
        F.sum("row_count")).first()[0]
    assert rest + late.count() == sum(len(b) for b in batches) and sums[0][1] <= rest
    assert {(r["year"], r["month"], r["late"]) for r in jobs.late_months(late).collect()} >= {
        ("2023", "12", 1)}


def test_batches_without_times_and_nothing(spark, tmp_path):
    source, root, marks = str(tmp_path / "src"), fresh_dir(spark, "windows"), fresh_dir(spark, "stream")
    assert jobs.finished_windows(spark, root).isEmpty()
    assert jobs.late_rows(spark, root, spark.createDataFrame([], FLOW).schema).isEmpty()
    for value in (None, "2024-01-30 00:00:00", None):
        spark.createDataFrame([(value, 31, 1)], "ts string, VehicleType int, Volume int").withColumn(
            "ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(source)
        jobs.split_flow(spark.readStream.schema(FLOW).parquet(source), root, marks).awaitTermination()
    late = jobs.late_rows(spark, root, spark.createDataFrame([], FLOW).schema)
    assert found(late, "Volume", "batch") == [(1, 0), (1, 2)]
    assert jobs.finished_windows(spark, root).isEmpty()
    assert jobs.finished_windows(spark, root, timedelta(0)).count() == 0
    assert jobs.finished_windows(spark, root, timedelta(minutes=-15)).count() == 1
