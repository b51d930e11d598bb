"""Landing, lake, streams, requests: written and read back in the shared folder."""

import io
import json
import tarfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from roadpulse import schemas
from roadpulse.functions.timeparts import TimeRange, months_of
from roadpulse.operators import alias as al
from roadpulse.operators import flow, quality, stations
from roadpulse.plans import convert, service
from roadpulse.session import fresh_dir, shared_dir
from roadpulse.sources import lake, landing, snapshots
from roadpulse.streaming import jobs


def rows(df, *keys):
    return [tuple(r) for r in (df.orderBy(*keys) if keys else df).collect()]


def put(path, name, text):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(text, encoding="utf-8")


def facts(spark, *values):
    return spark.createDataFrame(list(values), schemas.DETECTIONS)


def test_shared_dir_follows_the_session(spark):
    assert fresh_dir(spark, "x").startswith(shared_dir(spark))
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_csv_keeps_bad_rows(spark, tmp_path):
    put(tmp_path, "a.csv", "2024-01-01 00:00,A,N,31,5\n2024-01-01 00:00,A,N,car,5\nshort,A\n")
    assert rows(landing.csv_slots(spark, str(tmp_path), "M03A")) == [
        ("2024-01-01 00:00", "A", "N", 31, 5), ("2024-01-01 00:00", "A", "N", None, 5),
        ("short", "A", None, None, None)]


def test_strict_csv(spark, tmp_path):
    put(tmp_path, "a.csv", "﻿2024-01-01 00:00 , A ,N,31,5\n2024-1-1 0:05:30,B,S,x,+6\n"
        "2024-01-01 00:00,A,N,31,many\nnever,A,N,31,5\n2024-01-01 00:00,A,N,31\n"
        "2024-01-01 00:00,A,N,31,5,6\n2024-01-01T00:00,A,N,31,5\n2024-02-30 00:00,A,N,31,5\n2024,A,N,31,5\n")
    assert rows(landing.strict_csv(spark, str(tmp_path)), "time") == [
        ("2024-01-01 00:00:00", "A", "N", "31", 5), ("2024-01-01 00:05:30", "B", "S", "x", 6)]


def test_listing(spark, tmp_path):
    put(tmp_path / "year=2024" / "month=01", "TDCS_M03A_20240101_000000.csv", "x")
    put(tmp_path / "year=2024" / "month=01", "TDCS_M03A_20240101_000500.csv", "")
    put(tmp_path / "year=2024" / "month=02", "other.txt", "xyz")
    files = landing.listing(spark, str(tmp_path))
    # an empty file does not count as landed; Spark leaves it out of the listing
    assert sorted(r["length"] for r in files.collect()) == [1, 3]
    assert rows(quality.landed(files)) == [("M03A", date(2024, 1, 1), "0000",
                                            "TDCS_M03A_20240101_000000.csv")]
    months = landing.listed_partitions(files).select("year", "month").distinct()
    assert rows(months, "month") == [("2024", "01"), ("2024", "02")]
    assert rows(quality.coverage(months)) == [(date(2024, 1, 1), date(2024, 2, 29))]
    assert landing.listing(spark, str(tmp_path / "nowhere")).isEmpty()


def test_archives(spark, tmp_path):
    def pack(name, members):
        with tarfile.open(tmp_path / name, "w:gz") as tar:
            for member, data in members.items():
                info = tarfile.TarInfo(member)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
    pack("M03A_20240101.tar.gz", {"a/b/one.csv": b"2024-01-01 00:00,A,N,31,5\r\n", "x.txt": b"no",
                                  "two.csv": "﻿2024-01-01 00:05,A,N,31,x".encode()})
    pack("M03A_20240102.tar.gz", {"x.txt": b"no"})
    (tmp_path / "M03A_20240103.tar.gz").write_bytes(b"broken")
    lines = landing.archive_lines(landing.archives(spark, str(tmp_path / "*.tar.gz")))
    state = {r["archive"][-15:-7]: (r["members"], r["lines"], r["bad"])
             for r in landing.archive_state(lines).collect()}
    assert state == {"20240101": (2, 2, False), "20240102": (0, 0, True), "20240103": (0, 0, True)}
    assert rows(landing.parsed_lines(lines, "M03A"), "TimeInterval") == [
        ("2024-01-01 00:00", "A", "N", 31, 5), ("2024-01-01 00:05", "A", "N", 31, None)]


def test_dimensions(spark, tmp_path):
    put(tmp_path, "dim.csv", "﻿id,b,c,d,e,f,active,old,new\nA,,,,,,True,B,\n B ,,,,,,False,,A\n"
        ",,,,,,True,,\n")
    dim = landing.station_dimension(spark, str(tmp_path / "dim.csv"))
    assert rows(dim, "id") == [("A", True, "B", ""), ("B", False, "", "A")]
    assert rows(al.alias_table(dim).select("id", "canonical"), "id") == [("A", "A"), ("B", "A")]
    put(tmp_path, "groups.json", json.dumps([
        {"gantry_id": "01F0100S", "name": "one", "lat": "23.5", "lng": 121, "road": "R"},
        {"current_gantry_id": "01F0200N", "gantry_ids": ["01F0200N", "01F0199N"], "direction": "N",
         "versions": [{"first_seen": "2024-01-01", "last_seen": None, "is_active": True}]}]))
    groups = stations.normalize_groups(landing.station_groups(spark, str(tmp_path / "groups.json")))
    assert rows(groups.select("group_id", "name", "group_direction", "lat", "km"), "group_id") == [
        ("G_01F0100S", "one", "S", 23.5, 10.0), ("G_01F0200N", "01F0200N", "N", None, 20.0)]


def test_state_log_skips_broken_lines(spark, tmp_path):
    put(tmp_path, "log.json", '{"year": 2024, "month": 1, "status": "OK", "timestamp": "t1"}\n{"ye\n'
        '{"year": 2024}\n{"year": 2024, "month": 1, "status": "ERROR", "timestamp": "t2"}\n')
    log = landing.state_log(spark, str(tmp_path))
    assert rows(quality.latest_state(log)) == [(2024, 1, "ERROR")]


def detections(spark, month, n):
    return [(f"2024-{month:02d}-01 00:{i:02d}", "A", "N", 31, i) for i in range(n)]


def test_publish_holds_back_a_mismatch(spark, monkeypatch):
    root = fresh_dir(spark, "lake")
    first = lake.publish(facts(spark, *detections(spark, 1, 3), *detections(spark, 2, 4)), "M03A", root)
    assert rows(first, "month") == [("2024", "01", 3, 3, "OK"), ("2024", "02", 4, 4, "OK")]
    counts = lake.stored_counts

    def spoiled(spark, root, batch, schema):
        return {m: n - (m[1] == "01") for m, n in counts(spark, root, batch, schema).items()}
    monkeypatch.setattr(lake, "stored_counts", spoiled)
    second = lake.publish(facts(spark, *detections(spark, 1, 9), *detections(spark, 2, 9)), "M03A", root)
    assert [r["status"] for r in second.orderBy("month").collect()] == ["MISMATCH", "OK"]
    stored = lake.tree(spark, root, "M03A").groupBy("month").count()
    assert rows(stored, "month") == [("01", 3), ("02", 9)]
    view = "v_" + root.rsplit("-", 1)[-1]
    assert not lake.promote(spark, second, view, root, "M03A")
    assert lake.promote(spark, first, view, root, "M03A")
    assert spark.table(view).count() == 12
    assert spark.table(view).filter("month = '02'").count() == 9


def test_scan_prunes_and_pushes_down(spark):
    root = fresh_dir(spark, "lake")
    lake.publish(facts(spark, *detections(spark, 1, 3), *detections(spark, 3, 4)), "M03A", root)
    span = TimeRange.of("2024-03-01 00:00", "2024-03-01 23:59")
    df = flow.selected(lake.scan(spark, root, "M03A", span), span, ["A"]).select("Volume")
    assert df.count() == 4
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the version names the folders, so others are not even listed
    assert "GreaterThanOrEqual(TimeInterval,2024-03-01 00:00)" in plan
    assert "EqualTo(GantryID,A)" in plan or "In(GantryID" in plan
    files = df.inputFiles()
    assert files and all("month=03" in f for f in files)
    plain = fresh_dir(spark, "plain")
    lake.write_months(schemas.file_month(facts(spark, *detections(spark, 1, 3)), "TimeInterval"), plain)
    plan = lake.scan(spark, plain, "M03A", span)._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "year" in pruned and "month" in pruned
    assert lake.scan(spark, fresh_dir(spark, "none"), "M03A", span).isEmpty()


def test_month_predicate_spans_years(spark):
    months = spark.createDataFrame([(str(y), f"{m:02d}") for y in (2022, 2023, 2024)
                                    for m in range(1, 13)], "year string, month string")
    kept = months.filter(months_of(TimeRange.of("2023-12-01 00:00", "2024-01-31 12:00")))
    assert rows(kept, "year", "month") == [("2023", "11"), ("2023", "12"), ("2024", "01"),
                                           ("2024", "02")]
    assert months.filter(months_of(TimeRange.of("2022-06-01", "2024-02-01"))).count() == 22


def test_compaction_splits_a_hot_month(spark):
    root, out = fresh_dir(spark, "lake"), fresh_dir(spark, "compact")
    hot = spark.range(6000).select(
        F.format_string("2024-01-%02d %02d:%02d", F.col("id") % 28 + 1, F.col("id") % 24,
                        F.col("id") % 12 * 5).alias("TimeInterval"),
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("GantryID"),
        F.lit("N").alias("Direction"), F.lit(31).alias("VehicleType"), F.lit(1).alias("Volume"))
    cold = facts(spark, *detections(spark, 2, 9))
    lake.publish(hot.unionByName(cold), "M03A", root)
    lake.compact(lake.tree(spark, root, "M03A"), "M03A", out, 4)
    sizes = lake.tree(spark, out, "M03A").groupBy(F.input_file_name().alias("f"), "month").agg(
        F.count(F.lit(1)).alias("n"), F.min("TimeInterval").alias("lo"),
        F.max("TimeInterval").alias("hi")).filter("month = '01'").orderBy("lo").collect()
    assert len(sizes) >= 3 and max(r["n"] for r in sizes) < 3000
    assert all(a["hi"] <= b["lo"] for a, b in zip(sizes, sizes[1:]))
    again = fresh_dir(spark, "compact")
    lake.compact(lake.tree(spark, root, "M03A"), "M03A", again, 1, keep_order=True)
    assert lake.tree(spark, again, "M03A").count() == 6009
    folder = fresh_dir(spark, "files")
    lake.write_files(spark.range(100), folder, 2)
    assert len(spark.read.parquet(folder).inputFiles()) <= 2


def test_retype(spark):
    text = spark.createDataFrame([("31", "x"), ("bad", "1.5")], "VehicleType string, TripLength string")
    assert schemas.columns_to_retype(text) == ["VehicleType", "TripLength"]
    assert rows(schemas.retype(text)) == [(31, None), (None, 1.5)]


def test_copies_of_one_row_spread_over_files(spark):
    root = fresh_dir(spark, "hot")
    same = spark.range(0, 4000, 1, 8).select(
        F.lit("2024-01-01 00:00").alias("TimeInterval"), F.lit("A").alias("GantryID"),
        F.lit("N").alias("Direction"), F.lit(31).alias("VehicleType"), F.lit(1).alias("Volume"))
    check = lake.publish(same.unionByName(facts(spark, *detections(spark, 2, 9))), "M03A", root, 4)
    assert {r["status"] for r in check.collect()} == {"OK"}
    sizes = lake.tree(spark, root, "M03A").filter("month = '01'").groupBy(
        F.input_file_name()).count().collect()
    assert sum(r["count"] for r in sizes) == 4000
    assert len(sizes) >= 2 and max(r["count"] for r in sizes) < 4000


def test_retype_lake(spark):
    root = fresh_dir(spark, "lake")
    typed = spark.createDataFrame([(31, "2024-01-01 00:00:00", "A", "2024-01-01 00:10:00", "B", 1.5,
                                    "Y", "p", "2024", "01")], lake.lake_schema("M06A"))
    lake.write_months(typed, root)
    lake.write_months(typed.select(*[F.col(c).cast("string") for c in typed.columns]).withColumn(
        "month", F.lit("02")), root)
    assert [e.month for e in lake.text_months(spark, root)] == ["02"]
    assert rows(lake.retype_lake(spark, root, "M06A")) == [("2024", "02", 1, 1, "OK")]
    assert lake.text_months(spark, root) == [] and lake.retype_lake(spark, root, "M06A") is None
    assert rows(lake.tree(spark, root, "M06A").select("VehicleType", "TripLength", "month"),
                "month") == [(31, 1.5, "01"), (31, 1.5, "02")]


def slot(path, dtype, stamp, text):
    put(path, f"TDCS_{dtype}_{stamp}.csv", text)


def test_convert_days(spark, tmp_path):
    raw, root = tmp_path / "raw", fresh_dir(spark, "lake")
    for minute in range(0, 1440, 5):
        at = f"{minute // 60:02d}:{minute % 60:02d}"
        slot(raw, "M03A", f"20240131_{at.replace(':', '')}00", f"2024-01-31 {at},A,N,31,1\n")
    slot(raw, "M03A", "20240201_000000", "2024-02-01 00:00,A,N,31,1\n")
    days = date(2024, 1, 30), date(2024, 2, 2)
    check = convert.convert_days(spark, str(raw), root, *days)
    assert rows(check) == [("2024", "01", 288, 288, "OK")]
    assert convert.convert_days(spark, str(raw), root, *days).isEmpty()
    forced = convert.convert_days(spark, str(raw), root, *days, force=True)
    assert rows(forced.select("month", "dst_count"), "month") == [("01", 288), ("02", 1)]
    assert lake.tree(spark, root, "M03A").count() == 289


def test_convert_keeps_days_that_left_the_landing_folder(spark, tmp_path):
    raw, other, root = tmp_path / "raw", tmp_path / "other", fresh_dir(spark, "lake")
    for folder, day in ((raw, "03"), (other, "04")):
        for minute in range(0, 1440, 5):
            at = f"{minute // 60:02d}:{minute % 60:02d}"
            slot(folder, "M03A", f"202401{day}_{at.replace(':', '')}00", f"2024-01-{day} {at},A,N,31,1\n")
    days = date(2024, 1, 1), date(2024, 1, 9)
    convert.convert_days(spark, str(raw), root, *days)
    # the second day is a batch of its own, the first is not written again
    check = convert.convert_days(spark, str(other), root, *days)
    assert rows(check) == [("2024", "01", 288, 288, "OK")]
    stored = lake.tree(spark, root, "M03A").groupBy(F.substring("TimeInterval", 1, 10)).count()
    assert sorted(rows(stored)) == [("2024-01-03", 288), ("2024-01-04", 288)]
    assert convert.convert_days(spark, str(other), root, *days, force=True).first()["dst_count"] == 576
    opened = convert.landed_rows(spark, str(other), "M03A", ["20240104"])
    assert len(opened.inputFiles()) == 288
    assert convert.landed_rows(spark, str(other), "M03A", ["20240105"]).isEmpty()


def test_rows_without_a_time_are_published_apart(spark):
    root = fresh_dir(spark, "lake")
    data = facts(spark, ("2024-01-01 00:00", "A", "N", 31, 1)).unionByName(
        facts(spark, ("2024-01-01 00:00", "B", "N", 31, 2)).withColumn(
            "TimeInterval", F.lit(None).cast("string")))
    check = lake.publish(data, "M03A", root)
    assert sorted(rows(check)) == [("0000", "00", 1, 1, "OK"), ("2024", "01", 1, 1, "OK")]
    assert rows(lake.tree(spark, root, "M03A").select("GantryID", "month"), "GantryID") == [
        ("A", "01"), ("B", "00")]


def test_convert_months(spark, tmp_path):
    raw, root, marks = tmp_path / "raw", fresh_dir(spark, "lake"), fresh_dir(spark, "stamps")
    line = "31,2024-01-31 23:59:00,A,2024-02-01 00:10:00,B,1.5,Y,2024-01-31 23:59:00+A\n"
    slot(raw, "M06A", "20240131_230000", line)
    slot(raw, "M06A", "20240201_000000", line)
    first = convert.convert_months(spark, str(raw), root, marks)
    # a row is filed under the month of its file
    assert rows(first.select("month", "dst_count", "status"), "month") == [
        ("01", 1, "OK"), ("02", 1, "OK")]
    assert convert.convert_months(spark, str(raw), root, marks).isEmpty()
    slot(raw, "M06A", "20240201_010000", line)
    again = convert.convert_months(spark, str(raw), root, marks)
    assert rows(again.select("month", "dst_count")) == [("02", 1)]
    assert rows(lake.tree(spark, root, "M06A").groupBy("month").count(), "month") == [("01", 1), ("02", 2)]
    assert rows(lake.stamps(spark, marks).select("month", "raw_count"), "month") == [
        ("01", 1), ("02", 2)]


def test_stream_takes_each_file_once(spark, tmp_path):
    raw = tmp_path / "raw"
    root, checkpoint = fresh_dir(spark, "ingested"), fresh_dir(spark, "stream")

    def run():
        jobs.ingest(jobs.slots(spark, str(raw), "M03A", 1), "M03A", root, checkpoint
                    ).awaitTermination()
        return rows(jobs.ingested(spark, root, "M03A").groupBy("day").count(), "day")
    slot(raw, "M03A", "20240101_000000", "2024-01-01 00:00,A,N,31,1\n")
    slot(raw, "M03A", "20240101_000500", "2024-01-01 00:05,A,N,31,1\n")
    assert run() == [("2024-01-01", 2)]
    assert run() == [("2024-01-01", 2)]
    slot(raw, "M03A", "20240101_001000", "2024-01-01 00:10,A,N,31,1\n2024-01-02 00:00,A,N,31,1\n")
    assert run() == [("2024-01-01", 3), ("2024-01-02", 1)]


def test_late_rows_still_count(spark, tmp_path):
    out, checkpoint = fresh_dir(spark, "windows"), fresh_dir(spark, "stream")
    source, late = str(tmp_path / "src"), []

    def run(*values):
        spark.createDataFrame([(v, 31, 1) for v in values], "ts string, VehicleType int, Volume int"
                              ).withColumn("ts", F.col("ts").cast("timestamp")).write.mode(
            "append").parquet(source)
        stream = spark.readStream.schema("ts timestamp, VehicleType int, Volume int").parquet(source)
        query = jobs.drain(jobs.windowed_flow(stream), out, checkpoint)
        query.awaitTermination()
        late.append(jobs.dropped(query))
        stored = spark.read.schema("window_start timestamp, VehicleType int, volume bigint, "
                                   "row_count bigint").parquet(out)
        return [(str(r[0]), r[3]) for r in stored.orderBy("window_start").collect()]
    assert run("2024-01-01 00:01:00", "2024-01-20 00:00:00") == []
    # nineteen days late, still counted; then the watermark passes its window
    assert run("2024-01-01 00:14:00", "2024-01-26 00:00:00") == [("2024-01-01 00:00:00", 2)]
    # too late now, and counted as such
    assert run("2024-01-01 00:02:00", "2024-01-01 00:03:00") == [("2024-01-01 00:00:00", 2)]
    assert late[:2] == [0, 0] and late[2] > 0


def test_days_are_judged_by_files(spark, tmp_path):
    """Rows of a neighbouring day and unreadable ones neither hide a day nor repeat."""
    raw, root = tmp_path / "raw", fresh_dir(spark, "lake")
    for day in ("03", "04"):
        for minute in range(0, 1440, 5):
            at = f"{minute // 60:02d}:{minute % 60:02d}"
            more = "2024-01-04 23:00,A,N,31,1\nnever,B,N,31,1\n" if (day, minute) == ("03", 0) else ""
            if day == "03" or minute < 1435:
                slot(raw, "M03A", f"202401{day}_{at.replace(':', '')}00",
                     f"2024-01-{day} {at},A,N,31,1\n" + more)
    days = date(2024, 1, 3), date(2024, 1, 4)

    def stored():
        held = lake.tree(spark, root, "M03A")
        return held.count(), held.filter("TimeInterval = 'never'").count()
    assert rows(convert.convert_days(spark, str(raw), root, *days)) == [("2024", "01", 290, 290, "OK")]
    assert convert.convert_days(spark, str(raw), root, *days).isEmpty() and stored() == (290, 1)
    slot(raw, "M03A", "20240104_235500", "2024-01-04 23:55,A,N,31,1\n")
    assert rows(convert.convert_days(spark, str(raw), root, *days)) == [("2024", "01", 288, 288, "OK")]
    assert stored() == (578, 1)
    for _ in range(2):
        assert convert.convert_days(spark, str(raw), root, *days, force=True).first()["dst_count"] == 578
        assert stored() == (578, 1)
    # a file that landed again in another length takes the place of its own rows
    slot(raw, "M03A", "20240103_000000", "2024-01-03 00:00,A,N,31,1\n2024-01-03 00:00,B,N,31,1\n")
    convert.convert_days(spark, str(raw), root, *days)
    assert stored() == (577, 0)
    assert snapshots.sources(spark, root).count() == 576
    assert snapshots.sources(spark, root).select("name").distinct().count() == 576


def test_one_name_in_two_folders_counts_once(spark, tmp_path):
    root, marks = fresh_dir(spark, "lake"), fresh_dir(spark, "stamps")
    line = "31,2024-01-31 23:59:00,A,2024-02-01 00:10:00,B,1.5,Y,2024-01-31 23:59:00+A\n"
    slot(tmp_path / "raw" / "a b", "M06A", "20240131_230000", line * 2)
    slot(tmp_path / "raw" / "c", "M06A", "20240131_230000", line)
    slot(tmp_path / "raw" / "c", "M06A", "20240132_230000", line)
    check = convert.convert_months(spark, str(tmp_path / "raw"), root, marks)
    assert rows(check) == [("2024", "01", 2, 2, "OK")]


def test_months_keep_rows_whose_files_left(spark, tmp_path):
    raw, root, marks = tmp_path / "raw", fresh_dir(spark, "lake"), fresh_dir(spark, "stamps")
    line = "31,2024-01-{},A,2024-01-04 00:10:00,B,1.5,Y,x\n"
    slot(raw, "M06A", "20240103_010000", line.format("03 01:00:00") * 3)
    slot(raw, "M06A", "20240104_010000", line.format("04 01:00:00") * 2)
    convert.convert_months(spark, str(raw), root, marks)
    (raw / "TDCS_M06A_20240103_010000.csv").unlink()
    slot(raw, "M06A", "20240105_010000", line.format("05 01:00:00"))
    slot(raw, "M06A", "20240105_020000", "")
    assert rows(convert.convert_months(spark, str(raw), root, marks)) == [("2024", "01", 1, 1, "OK")]
    held = lake.tree(spark, root, "M06A").groupBy(F.substring("DetectionTime_O", 9, 2)).count()
    assert sorted(rows(held)) == [("03", 3), ("04", 2), ("05", 1)]
    assert rows(lake.stamps(spark, marks).select("raw_count")) == [(3,)]


def test_publishes_keep_bad_times_apart(spark):
    root = fresh_dir(spark, "lake")
    lake.publish(facts(spark, ("x", "A", "N", 31, 1), ("2024-01-01 00:00", "A", "N", 31, 1)), "M03A", root)
    lake.publish(facts(spark, ("2024-13-01 00:00", "B", "N", 31, 1), ("2024-02-01 00:00", "A", "N", 31, 1)),
                 "M03A", root)
    assert rows(lake.tree(spark, root, "M03A").select("year", "month", "GantryID"),
                "year", "month", "GantryID") == [
        ("0000", "00", "A"), ("0000", "00", "B"), ("2024", "01", "A"), ("2024", "02", "A")]


def test_readers_see_one_version(spark):
    root = fresh_dir(spark, "lake")
    lake.publish(facts(spark, *detections(spark, 1, 5)), "M03A", root)
    before = lake.tree(spark, root, "M03A")
    lake.publish(facts(spark, *detections(spark, 1, 8), *detections(spark, 2, 2)), "M03A", root)
    assert (before.count(), lake.tree(spark, root, "M03A").count()) == (5, 10)
    assert snapshots.read(spark, root, schemas.DETECTIONS, version=1).count() == 5
    # a batch that no version names is not there for readers
    lake.write_batch(lake.filed(facts(spark, *detections(spark, 3, 9)), "M03A"), root, 2, schemas.DETECTIONS)
    assert lake.tree(spark, root, "M03A").count() == 10
    assert snapshots.drop_old(spark, root, keep=1) == []
    assert len(snapshots.drop_old(spark, root, keep=1, hours=-1)) == 2
    assert lake.tree(spark, root, "M03A").count() == 10 and snapshots.numbers(spark, root) == [2]


def test_two_writers(spark):
    root = fresh_dir(spark, "lake")
    lake.publish(facts(spark, *detections(spark, 1, 5), *detections(spark, 2, 5)), "M03A", root)

    def entry(month, n):
        batch, check = lake.write_batch(lake.filed(facts(spark, *detections(spark, month, n)), "M03A"),
                                        root, 1, schemas.DETECTIONS)
        return [snapshots.Entry(y, m, batch, rows, 0) for y, m, _, rows, _ in check]
    one, other, same = entry(1, 7), entry(2, 9), entry(1, 3)
    assert snapshots.commit(spark, root, 1, one, [("2024", "01")]) == 2
    # another month goes on top, the same month is refused
    assert snapshots.commit(spark, root, 1, other, [("2024", "02")]) == 3
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, root, 1, same, [("2024", "01")])
    assert lake.tree(spark, root, "M03A").count() == 16


def test_a_plain_lake_is_taken_over(spark):
    root = fresh_dir(spark, "lake")
    old = facts(spark, *detections(spark, 1, 3), *detections(spark, 2, 4))
    lake.write_months(schemas.file_month(old, "TimeInterval"), root)
    lake.publish(facts(spark, *detections(spark, 2, 9)), "M03A", root)
    assert rows(lake.tree(spark, root, "M03A").groupBy("month").count(), "month") == [("01", 3), ("02", 9)]


def test_publish_reads_its_source_once(spark):
    root, reads = fresh_dir(spark, "lake"), spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch
    source = facts(spark, *detections(spark, 1, 30), *detections(spark, 2, 20)).repartition(7)
    check = lake.publish(source.mapInPandas(seen, schemas.DETECTIONS), "M03A", root)
    assert rows(check, "month") == [("2024", "01", 30, 30, "OK"), ("2024", "02", 20, 20, "OK")]
    assert reads.value == 50
    assert lake.publish(source.limit(0), "M03A", root).isEmpty()


def test_counts_on_the_way_are_exact(spark, monkeypatch):
    rows_ = spark.range(0, 60_000, 1, 16).select(
        F.format_string("%04d", 1900 + F.col("id") % 150).alias("year"),
        F.format_string("%02d", F.col("id") % 12 + 1).alias("month"))
    passing, seen = lake.counted(rows_)
    passing.write.format("noop").mode("overwrite").save()
    assert lake.observed(seen) == lake.by_month(rows_)
    monkeypatch.setattr(lake, "MOST_MONTHS", 50)
    passing, seen = lake.counted(rows_)
    passing.write.format("noop").mode("overwrite").save()
    assert lake.observed(seen) is None


def test_files_by_size(spark, tmp_path):
    """A month of most rows, most of them in one hour, gets files of equal size in time order."""
    root = fresh_dir(spark, "lake")
    hot = spark.range(0, 40_000, 1, 6).select(
        F.when(F.col("id") % 2 == 0, "2024-01-05 08:00").otherwise(F.format_string(
            "2024-01-%02d %02d:00", F.col("id") % 28 + 1, F.col("id") % 24)).alias("TimeInterval"),
        F.sha2(F.col("id").cast("string"), 256).alias("GantryID"), F.lit("N").alias("Direction"),
        F.lit(31).alias("VehicleType"), F.lit(1).alias("Volume"))
    lake.publish(hot.unionByName(facts(spark, *detections(spark, 2, 9))), "M03A", root)
    total = lake.stored_files(spark, root).filter("month = '01'").agg(F.sum("length")).first()[0]
    target = total // 6
    check = lake.rewrite(spark, root, "M03A", target, force=True)
    assert rows(check, "month") == [("2024", "01", 40_000, 40_000, "OK"), ("2024", "02", 9, 9, "OK")]
    sizes = [r["length"] for r in lake.stored_files(spark, root).filter("month = '01'").collect()]
    assert len(sizes) == 6 and max(sizes) < 2 * target and min(sizes) > target / 2
    assert lake.stored_files(spark, root).filter("month = '02'").count() == 1
    spans = lake.tree(spark, root, "M03A").filter("month = '01'").groupBy(F.input_file_name().alias("f")).agg(
        F.min(F.substring("TimeInterval", 1, 13)).alias("lo"), F.max(F.substring("TimeInterval", 1, 13)).alias("hi")
    ).orderBy("lo", "hi").collect()
    assert all(a["hi"] <= b["lo"] for a, b in zip(spans, spans[1:]))
    assert lake.rewrite(spark, root, "M03A", target).isEmpty()
    # several batches of a month become one, and the ledger of its files goes with it
    raw = tmp_path / "raw"
    for hour in range(2):
        slot(raw, "M06A", f"20240131_0{hour}0000", f"31,2024-01-31 0{hour}:59:00,A,,B,1.5,Y,x\n")
        convert.convert_months(spark, str(raw), root + "t", root + "s")
    assert len(snapshots.entries(spark, root + "t")) == 2
    lake.rewrite(spark, root + "t", "M06A")
    assert len(snapshots.entries(spark, root + "t")) == 1
    assert snapshots.sources(spark, root + "t").count() == 2
    assert convert.convert_months(spark, str(raw), root + "t", root + "s").isEmpty()


@pytest.fixture(scope="module")
def data(spark):
    m03, m06 = fresh_dir(spark, "lake"), fresh_dir(spark, "lake")
    lake.publish(facts(spark, ("2024-01-01 08:00", "01F0339N", "N", 31, 2),
                       ("2024-01-01 08:05", "01F0340N", "N", 31, 3),
                       ("2024-01-02 09:00", "01F0340N", "N", 5, 5),
                       ("2024-01-02 09:00", "01F0100S", "S", 5, 7)), "M03A", m03)
    path = "2024-01-01 08:00:00+01F0339N; 2024-01-01 08:10:00+01F0200N; 2024-01-01 08:20:00+01F0100N"
    lake.publish(spark.createDataFrame([
        (31, "2024-01-01 08:00:00", "01F0339N", "2024-01-01 08:20:00", "01F0100N", 20.0, "Y", path)],
        schemas.TRIPS), "M06A", m06)
    alias = al.alias_table(spark.createDataFrame([("01F0340N", True, "01F0339N", None)],
                                                 "id string, is_active boolean, old_id string, new_id string"))
    groups = stations.normalize_groups(spark.createDataFrame(
        [("G1", "01F0340N", ["01F0340N"], "one", "N")],
        "group_id string, current_gantry_id string, gantry_ids array<string>, display_name string, "
        "direction string"))
    sections = stations.with_aliases(stations.group_lookup(groups), alias)
    return service.TrafficData(spark, m03, m06, alias, sections)


def test_flow_request(data):
    answer = service.query(data, {
        "dataset": "M03A", "start_time": "2024-01-01 00:00", "end_time": "2024-01-02 23:59",
        "gantry_ids": ["01F0340N"], "direction": "n", "vehicle_type": ""})
    assert rows(answer.rows, "time") == [
        ("2024-01-01 08:00", "01F0340N", "N", "31", 2),
        ("2024-01-01 08:05", "01F0340N", "N", "31", 3),
        ("2024-01-02 09:00", "01F0340N", "N", "5", 5)]


def test_od_request(data):
    answer = service.query(data, {
        "dataset": "M06A", "start_time": "2024-01-01 08:00:00", "end_time": "2024-01-01 09:00:00",
        "start_gantry_ids": ["01F0340N"], "start_gantry": "01F0340N", "end_gantry": "01F0100N"})
    assert rows(answer.rows) == [
        ("2024-01-01 08:00", "31", 1, 20.0, "01F0340N", "01F0100N")]
    assert rows(answer.route) == [("01F0339N,01F0200N,01F0100N", 1)]


def test_od_answer_reads_the_paths_once(data):
    ask = {"start_time": "2024-01-01 08:00:00", "end_time": "2024-01-01 09:00:00",
           "start_gantry_ids": ["01F0340N"], "start_gantry": "01F0340N", "end_gantry": "01F0100N"}
    answer = service.od_answer(data, ask)
    got = [tuple(r) for r in answer.select("part", "origin_time", "vehicle_type", "trip_count",
                                           "route", "avg_travel_time_minutes", "start_gantry").collect()]
    assert got == [("time", "2024-01-01 08:00", "31", 1, None, 20.0, "01F0340N"),
                   ("route", None, None, 1, "01F0339N,01F0200N,01F0100N", 20.0, "01F0340N")]
    plan = answer._jdf.queryExecution().executedPlan()
    answer._jdf.collect()
    final = plan.toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
    nobody = {**ask, "start_time": "2023-01-01 08:00:00", "end_time": "2023-01-01 09:00:00"}
    assert service.od_answer(data, nobody).isEmpty()


def test_dashboard(data):
    day = service.dashboard(data, {"period_type": "daily", "start_date": "2024-01-02",
                                   "end_date": "2024-01-02"})
    got = {(r["panel"], r["key"]): (r["volume"], r["row_count"], r["share"]) for r in day.collect()}
    assert got["total", ""] == (12, 2, 100.0)
    assert got["bucket", "2024-01-02 09:00"] == got["day", "2024-01-02"] == (12, 2, 100.0)
    assert got["section", "RAW_01F0100S"] == (7, 1, 58.3) and got["section", "G1"] == (5, 1, 41.7)
    week = {"period_type": "weekly", "start_date": "2023-12-31", "end_date": "2024-01-06"}
    # the old id counts with its successor
    assert rows(service.dashboard(data, week).filter("panel = 'section'").select("key", "volume"),
                "key") == [("G1", 10), ("RAW_01F0100S", 7)]
    assert service.dashboard(data, {**week, "start_date": "2020-01-01",
                                    "end_date": "2020-01-07"}).isEmpty()
    bare = service.TrafficData(data.spark, data.detections_root, data.trips_root)
    assert rows(service.dashboard(bare, week).filter("panel = 'section'").select("key"), "key")[-1] \
        == ("RAW_01F0340N",)


def test_answers_come_in_order(data):
    flows = service.query(data, {"dataset": "M03A", "start_time": "2024-01-01 00:00",
                                 "end_time": "2024-01-31 00:00"}).rows.collect()
    keys = [(r["time"], r["gantry_id"], r["direction"], r["vehicle_type"]) for r in flows]
    assert keys == sorted(keys) and len(keys) == 4
    month = service.dashboard_answer(data, {"period_type": "monthly", "start_date": "2024-01-01",
                                            "end_date": "2024-01-31"}).collect()
    assert [(r["panel"], r["place"], r["key"], r["volume"], r["name"], r["direction"]) for r in month] == [
        ("day", 1, "2024-01-01", 5, None, None), ("day", 2, "2024-01-02", 12, None, None),
        ("section", 1, "G1", 10, "one", "N"), ("section", 2, "RAW_01F0100S", 7, "01F0100S", "S"),
        ("total", 1, "", 17, None, None),
        *[("vehicle", k, v, n, None, None) for k, (v, n) in enumerate(
            [("31", 5), ("32", 0), ("41", 0), ("42", 0), ("5", 12)], 1)]]
    assert {r["label"] for r in month} == {"月流量｜2024/01/01 ～ 2024/01/31"}
    day = service.dashboard_answer(data, {"period_type": "daily", "start_date": "2024-01-02",
                                          "end_date": "2024-01-02"}).collect()
    assert [r["key"] for r in day if r["panel"] == "hour"] == ["2024-01-02 09:00"]
    assert service.dashboard_answer(data, {"period_type": "daily", "start_date": "2020-01-02",
                                           "end_date": "2020-01-02"}).collect() == []


def test_time_tables_and_breakdown_are_ordered(spark):
    span = TimeRange.of("2024-01-01 00:00", "2024-01-20 00:00")
    flows = spark.createDataFrame(
        [(f"2024-01-{d:02d} 00:00", "A", v, d) for d in (9, 3, 17, 1) for v in ("31", " ", None, "5")],
        "time string, gantry_id string, vehicle_type string, traffic_volume int").repartition(4)
    days = [r["bucket"] for r in flow.trend(flows, span).collect()]
    assert days == sorted(days) and len(days) == 4
    kinds = [(r["vehicle_type"], r["volume"]) for r in flow.vehicle_breakdown(flows).collect()]
    assert kinds == [("未分類", 60), ("31", 30), ("5", 30)]


def test_held_aliases_resolve_as_the_table_does(spark):
    table = spark.createDataFrame(
        [(f"{g}{k}", g) for g in "ABC" for k in range(4)], "id string, component string").withColumns(
        {"canonical": F.col("component"), "members": F.lit(4)})
    index, joined = al.AliasIndex(table), al.AliasIndex(table, most=3)
    assert index.component is not None and joined.component is None
    for ids in ([], ["A1"], ["A1", "A3", "B0"], ["x", "C2", "C2", "A0", "C1", "x"], ["B3", "B0", "B3"]):
        assert index.request_ids(ids) == al.request_ids(table, ids) == joined.request_ids(ids)


def test_pages_and_coverage(data):
    page = service.detections_page(data, "2024-01-01 00:00", "2024-01-03 00:00", "01F0340N,01F0100S",
                                   "5", 1, 1)
    assert rows(page.select("GantryID")) == [("01F0340N",)]
    assert service.trips_page(data, "2024-01-01 00:00:00", "2024-01-02 00:00:00", "01F0340N",
                              "01F0200N").count() == 1
    assert rows(data.coverage("M03A")) == [(date(2024, 1, 1), date(2024, 1, 31))]


@pytest.mark.parametrize("payload", [
    {"dataset": "M05A", "start_time": "2024-01-01", "end_time": "2024-01-02"},
    {"dataset": "M03A", "start_time": "2024-01-02", "end_time": "2024-01-01"},
    {"dataset": "M06A", "start_time": "2024-01-01", "end_time": "2024-06-01"},
    {"dataset": "M06A", "start_time": "2024-01-01", "end_time": "2024-01-02", "start_gantry": "A"},
])
def test_refused_requests(data, payload):
    with pytest.raises(ValueError):
        service.query(data, payload)


def test_refused_pages(data):
    with pytest.raises(ValueError):
        service.dashboard(data, {"period_type": "yearly"})
