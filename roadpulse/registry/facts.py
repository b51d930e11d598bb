"""The fixtures as a lake: facts and dimensions stored once per application.

Queries then read what they would read in production: Parquet facts partitioned
by month with the path and times as stored columns, and small stored dimensions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadpulse import fixtures
from roadpulse.functions.timeparts import TimeRange
from roadpulse.operators import alias as al
from roadpulse.operators import stations
from roadpulse.plans.service import TrafficData
from roadpulse.schemas import FACT_TIME, file_month
from roadpulse.session import cut_lineage, fresh_dir
from roadpulse.sources import lake

_KEPT: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, label: str, build: Callable):
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _KEPT:
        _KEPT[key] = build()
    return _KEPT[key]


def root_of(spark: SparkSession, sf_dir: str, dtype: str) -> str:
    def build() -> str:
        rows = {"M03A": fixtures.detections, "M06A": fixtures.trips}[dtype](spark, sf_dir)
        root = fresh_dir(spark, f"lake-{dtype}")
        lake.write_months(file_month(rows, FACT_TIME[dtype]), root)
        return root

    return once(spark, sf_dir, dtype, build)


def detections_of(spark: SparkSession, sf_dir: str, span: TimeRange | None = None) -> DataFrame:
    root = root_of(spark, sf_dir, "M03A")
    return lake.tree(spark, root, "M03A") if span is None else lake.scan(spark, root, "M03A", span)


def trips_of(spark: SparkSession, sf_dir: str, span: TimeRange | None = None) -> DataFrame:
    root = root_of(spark, sf_dir, "M06A")
    return lake.tree(spark, root, "M06A") if span is None else lake.scan(spark, root, "M06A", span)


def listing_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files as a stored listing."""
    return once(spark, sf_dir, "listing", lambda: cut_lineage(
        fixtures.raw_listing(spark, sf_dir)))


def groups_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized road sections."""
    return once(spark, sf_dir, "groups", lambda: cut_lineage(
        stations.normalize_groups(fixtures.station_groups(spark, sf_dir))))


def lookup_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section of each station id."""
    return stations.group_lookup(groups_of(spark, sf_dir))


def alias_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renumbered stations."""
    return once(spark, sf_dir, "alias", lambda: al.alias_table(
        cut_lineage(fixtures.station_dimension(spark, sf_dir))))


def alias_index_of(spark: SparkSession, sf_dir: str) -> al.AliasIndex:
    """The same, held for the requests of this application."""
    return once(spark, sf_dir, "alias index", lambda: al.AliasIndex(alias_of(spark, sf_dir)))


def sections_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section of each station id, renumbered ones through their canonical id."""
    return once(spark, sf_dir, "sections", lambda: cut_lineage(
        stations.with_aliases(lookup_of(spark, sf_dir), alias_of(spark, sf_dir))))


def data_of(spark: SparkSession, sf_dir: str) -> TrafficData:
    """Everything a request needs."""
    return TrafficData(spark, root_of(spark, sf_dir, "M03A"), root_of(spark, sf_dir, "M06A"),
                       alias_of(spark, sf_dir), sections_of(spark, sf_dir))
