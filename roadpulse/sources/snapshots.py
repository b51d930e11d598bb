"""Versions of a stored fact: which folders make up each month, published by one rename.

    root/batches/batch=B/year=Y/month=MM/   rows of one write, never changed afterwards
    root/sources/batch=B/year=Y/month=MM/   names and lengths of the files those rows came from
    root/versions/N/                        the entries of version N

A write goes to a new batch, which no reader sees until the next version names it. A version
is written aside and renamed to its number last; the rename refuses a number that exists, so
of two writers that began from one version the second fails and loses nothing of the first.
Readers resolve a version once and read its folders only, no listing of the others. Months
laid down as plain ``root/year=Y/month=MM`` folders before the first version are part of it, under
the empty batch. :func:`drop_old` removes what kept versions do not name.

A month may hold several batches, so a day is added without rewriting its month; compaction
merges them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.session import drop_dir, list_dir, rename_new

MONTH_KEYS = ["year", "month"]
_KEYS = [T.StructField(name, T.StringType()) for name in ("batch", *MONTH_KEYS)]
SOURCE = T.StructType([T.StructField("name", T.StringType()), T.StructField("length", T.LongType())])
#: Column of stored rows that names the source file; readers of the fact do not see it.
SOURCE_FILE = "source_file"


class Conflict(Exception):
    """Another writer published the same months in the meantime."""


class Entry(NamedTuple):
    """A folder of a version; ``files`` counts the source files it knows of."""

    year: str
    month: str
    batch: str
    rows: int | None
    files: int

    def path(self, root: str, kind: str = "batches") -> str:
        where = f"{root}/{kind}/batch={self.batch}" if self.batch else root
        return f"{where}/year={self.year}/month={self.month}"


_ENTRY = "year string, month string, batch string, rows long, files long"
#: Entries of versions read before; a version never changes.
_KNOWN: dict[tuple[str, str, int], list[Entry]] = {}


def numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(name) for name, _ in list_dir(spark, f"{root}/versions") if name.isdigit())


def latest(spark: SparkSession, root: str) -> int:
    """Number of the newest version; 0 before the first."""
    return max(numbers(spark, root), default=0)


def entries(spark: SparkSession, root: str, version: int | None = None) -> list[Entry]:
    """The folders of a version, the newest by default: one for each month and batch."""
    version = latest(spark, root) if version is None else version
    if not version:
        return [Entry(year[5:], month[6:], "", None, 0)
                for year, _ in sorted(list_dir(spark, root)) if year.startswith("year=")
                for month, _ in sorted(list_dir(spark, f"{root}/{year}")) if month.startswith("month=")]
    key = (spark.sparkContext.applicationId, root, version)
    if key not in _KNOWN:
        if len(_KNOWN) > 64:
            _KNOWN.clear()
        rows = spark.read.schema(_ENTRY).parquet(f"{root}/versions/{version}").collect()
        _KNOWN[key] = sorted(Entry(*row) for row in rows)
    return _KNOWN[key]


def _read(spark: SparkSession, root: str, kind: str, schema: T.StructType,
          live: Iterable[Entry]) -> DataFrame:
    live = list(live)
    parts = []
    batched = [e.path(root, kind) for e in live if e.batch]
    if batched:
        parts.append(spark.read.schema(T.StructType(schema.fields + _KEYS))
                     .option("basePath", f"{root}/{kind}").parquet(*batched))
    plain = [e.path(root) for e in live if not e.batch]
    if plain:
        parts.append(spark.read.schema(T.StructType(schema.fields + _KEYS[1:])).option("basePath", root)
                     .parquet(*plain).withColumn("batch", F.lit(""))
                     .select(*schema.names, "batch", *MONTH_KEYS))
    if not parts:
        return spark.createDataFrame([], T.StructType(schema.fields + _KEYS))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read(spark: SparkSession, root: str, schema: T.StructType,
         keep: Callable[[Entry], bool] = lambda entry: True, version: int | None = None) -> DataFrame:
    """Rows of the kept folders of a version, with year and month; no other folder is listed."""
    live = [e for e in entries(spark, root, version) if e.rows != 0 and keep(e)]
    return _read(spark, root, "batches", schema, live).drop("batch")


def sources(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Ledger of a version: name and length of the files its rows came from, batch, year, month."""
    return _read(spark, root, "sources", SOURCE, [e for e in entries(spark, root, version) if e.files])


def new_batch(version: int) -> str:
    return f"{version + 1:08d}-{uuid.uuid4().hex[:12]}"


def batch_dir(root: str, kind: str, batch: str) -> str:
    return f"{root}/{kind}/batch={batch}"


def commit(spark: SparkSession, root: str, base: int, added: list[Entry],
           months: Iterable[tuple[str, str]] = ()) -> int:
    """Publish ``added`` in the next version; all older batches of ``months`` go.

    The work was done on version ``base``. Versions published since then stay, unless they
    changed one of ``months``: that is a :class:`Conflict`, and nothing is published.
    """
    months = set(months)

    def of_months(version: int) -> list[Entry]:
        return [e for e in entries(spark, root, version) if e[:2] in months]

    while True:
        now = latest(spark, root)
        if now != base and of_months(now) != of_months(base):
            raise Conflict(f"months {sorted(months)} of {root} changed since version {base}")
        rows = [e for e in entries(spark, root, now) if e[:2] not in months] + list(added)
        aside = f"{root}/versions/_aside-{uuid.uuid4().hex}"
        spark.createDataFrame(rows, _ENTRY).coalesce(1).write.parquet(aside)
        if rename_new(spark, aside, f"{root}/versions/{now + 1}"):
            return now + 1
        drop_dir(spark, aside)


def drop_old(spark: SparkSession, root: str, keep: int = 2, hours: float = 24.0) -> list[str]:
    """Remove versions but the newest ``keep``, and batches that no kept version names.

    Batches younger than ``hours`` stay, as their writers may not have published yet. Returns
    the removed batches.
    """
    known = numbers(spark, root)
    named = {e.batch for number in known[-keep:] for e in entries(spark, root, number)}
    for number in known[:-keep]:
        drop_dir(spark, f"{root}/versions/{number}")
    limit, gone = (time.time() - 3600 * hours) * 1000, set()
    for kind in ("batches", "sources"):
        for name, changed in list_dir(spark, f"{root}/{kind}"):
            batch = name.removeprefix("batch=")
            if known and batch not in named and changed < limit:
                drop_dir(spark, f"{root}/{kind}/{name}")
                gone.add(batch)
    return sorted(gone)
