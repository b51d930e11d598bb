"""Headline queries, warm, median of three; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from roadpulse.registry import QUERIES
from roadpulse.registry.facts import data_of
from roadpulse.session import build_session

HEADLINE = [
    "stats_hourly", "stats_daily", "stats_road_ranking", "stats_vehicle_share", "stats_panels", "dashboard",
    "flow_5min", "flow_hourly", "flow_daily", "flow_alias_expanded", "flow_metrics",
    "flow_station_ranking", "od_travel_time", "od_travel_time_vehicle", "od_metrics",
    "od_modal_route", "trip_detail_page", "slot_missing", "day_completeness", "stale_months",
    "drop_compare_vehicle", "lake_publish",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus,
                          spark_ui_enabled="false", spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    begin = time.perf_counter()
    data_of(spark, sf_dir)
    build = time.perf_counter() - begin
    seconds, rows = {}, {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):
            begin = time.perf_counter()
            rows[name] = len(QUERIES[name](spark, sf_dir).collect())
            runs.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(build + sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "rows": rows, "lake_build": round(build, 3),
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
