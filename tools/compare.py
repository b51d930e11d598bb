"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

    python tools/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from roadpulse.registry import QUERIES, SQL  # noqa: E402
from roadpulse.session import build_session  # noqa: E402


def plain(value):
    if isinstance(value, float):
        return float(f"{value:.9g}")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = args or list(QUERIES)
    if os.environ.get("PLAIN"):
        # Spark's own defaults, as a caller's session may have them
        spark = SparkSession.builder.master("local[8]").config(
            "spark.ui.showConsoleProgress", "false").getOrCreate()
    else:
        spark = build_session(master="local[8]", spark_sql_shuffle_partitions="8",
                              spark_ui_enabled="false", spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    bad = 0
    for name in names:
        begin = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            got = rows_of(df.columns, df.collect())
        except Exception as error:  # noqa: BLE001
            print(f"FAIL {name}: spark: {str(error)[:600]}", flush=True)
            bad += 1
            continue
        took = time.time() - begin
        if name not in SQL:
            print(f"rows {name}: {sum(got.values())} rows, {took:.1f}s", flush=True)
            continue
        try:
            result = db.execute(SQL[name])
            columns = [d[0] for d in result.description]
            types = {d[0]: str(d[1]) for d in result.description}
            want = rows_of(columns, result.fetchall())
        except Exception as error:  # noqa: BLE001
            print(f"FAIL {name}: sql: {str(error)[:600]}", flush=True)
            bad += 1
            continue
        if sorted(columns) != sorted(df.columns):
            print(f"FAIL {name}: columns {sorted(df.columns)} / {sorted(columns)}")
            bad += 1
        elif got != want:
            print(f"FAIL {name}: {sum(got.values())} / {sum(want.values())} rows; "
                  f"only spark {list((got - want).items())[:3]}; only sql "
                  f"{list((want - got).items())[:3]}", flush=True)
            bad += 1
        else:
            loose = {c: (t, types[c]) for c, t in df.dtypes if not same_type(t, types[c])}
            print(f"ok   {name}: {sum(got.values())} rows, {took:.1f}s {loose or ''}", flush=True)
    return bad


def same_type(spark_type: str, duck_type: str) -> bool:
    pairs = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "boolean": "BOOLEAN", "date": "DATE"}
    return pairs.get(spark_type) == duck_type


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
