"""Pages by an index of key ranges: the same rows as sorting everything, from a part of the input."""

import random

import pytest
from pyspark.sql import functions as F

from roadpulse.functions.timeparts import TimeRange
from roadpulse.operators import flow, pages
from roadpulse.plans import service
from roadpulse.session import fresh_dir
from roadpulse.sources import lake

SCHEMA = "time string, station string, volume int, km double"


def in_order(values):
    return sorted(values, key=lambda r: [(v is not None, v) for v in r])


def taken(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def values():
    draw = random.Random(5)
    some = [(draw.choice([None, "", "2024-01-01 00:05", "2024-01-02 10:00", "x"]),
             draw.choice([None, "A", "B"]), draw.choice([None, *range(40)]),
             draw.choice([None, 0.5, -1.0])) for _ in range(900)]
    # One row makes up a third of all.
    return some + [("2024-01-01 00:05", "A", 7, 0.5)] * 450


@pytest.mark.parametrize("block", [1, 17, 10_000])
def test_pages_are_those_of_the_sorted_rows(spark, values, block):
    found = pages.index(spark.createDataFrame(values, SCHEMA).repartition(7),
                        ["time", "station", "volume", "km"], block)
    want = in_order(values)
    assert found.total() == len(want)
    for offset, limit in ((0, 5), (0, 2000), (333, 60), (700, 1), (1300, 100), (1349, 1),
                          (1350, 10), (9999, 3), (20, 0)):
        assert taken(found.page(limit, offset)) == want[offset:offset + limit], (offset, limit)


def test_pages_follow_each_other(spark, values):
    found = pages.index(spark.createDataFrame(values, SCHEMA), ["volume", "km", "time", "station"], 50)
    rows = sum((taken(found.page(400, at)) for at in range(0, 1350, 400)), [])
    assert rows == in_order([(c, d, a, b) for a, b, c, d in values])


def test_nothing_and_refused(spark):
    empty = pages.index(spark.createDataFrame([], SCHEMA), ["time", "station", "volume", "km"])
    assert empty.total() == 0 and taken(empty.page(5)) == []
    with pytest.raises(ValueError):
        empty.page(-1)
    with pytest.raises(ValueError):
        empty.page(1, -1)
    with pytest.raises(ValueError):
        pages.index(spark.createDataFrame([], SCHEMA), ["time"])


def test_a_far_page_reads_its_range(spark):
    root = fresh_dir(spark, "lake")
    times = [f"2024-01-{d:02d} {h:02d}:00" for d in range(1, 29) for h in range(24)]
    lake.publish(spark.createDataFrame([(t, g, "N", 31, 1) for t in times for g in ("A", "B", "C")],
                                       lake.FACTS["M03A"]), "M03A", root)
    span = TimeRange.of("2024-01-01 00:00", "2024-01-31 23:59")
    data = service.TrafficData(spark, root, root)
    found = flow.detail_pages(data.detections(span), span, block=100)
    page = found.page(10, 1500)
    low = times[1400 // 3]
    plan = page._jdf.queryExecution().executedPlan().toString()
    bounds = [t for t in times if f"GreaterThanOrEqual(TimeInterval,{t})" in plan]
    assert bounds and bounds[-1] >= low
    everything = flow.detail_page(data.detections(span), span, 10, 1500)
    assert taken(page) == taken(everything)
    # What meets in one task is the range of the page, not all that lies before it.
    start = found.marks.filter(F.col("before") <= 1500).orderBy(F.desc("before")).first()
    stop = found.marks.filter(F.col("before") >= 1510).orderBy("before").first()
    assert found.between(start["first"], stop["first"]).count() <= 210
    asked = service.detections_pages(data, "2024-01-01 00:00", "2024-01-31 23:59", "A,B")
    assert asked.total() == 2 * len(times)
