"""Renumbered stations: alias groups, canonical ids, expansion and attribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.session import cut_lineage


def links(dimension: DataFrame) -> DataFrame:
    """Pairs ``(id, other)`` out of the old and new id of each renumbering record."""
    clean = dimension.select(*[F.trim(c).alias(c) for c in ("id", "old_id", "new_id")])
    return (clean.select("id", F.explode(F.array("old_id", "new_id")).alias("other"))
            .filter((F.col("id") != "") & (F.col("other") != "")))


def components(pairs: DataFrame) -> DataFrame:
    """Connected components ``(id, component)``; ``component`` is the smallest id.

    Each round lowers a label to the smallest label next to it and then to that
    label's own label, so a chain shortens by halves. Grouping by ``min`` combines
    before the shuffle, and every join has one row per id on one side, which lets
    AQE split a hot id. Each round ends in a table in the shared folder.
    """
    both = pairs.select("id", "other").unionByName(
        pairs.select(F.col("other").alias("id"), F.col("id").alias("other")))
    both = cut_lineage(both.filter(F.col("id") != F.col("other")).distinct())
    label = both.groupBy("id").agg(F.min("other").alias("near")).select(
        "id", F.least("id", "near").alias("component"))
    while True:
        near = (both.join(label.select(F.col("id").alias("other"), "component"), "other")
                .groupBy("id").agg(F.min("component").alias("near")))
        lowered = label.join(near, "id").select(
            "id", F.col("component").alias("before"),
            F.least("component", "near").alias("component"))
        jump = label.select(F.col("id").alias("component"), F.col("component").alias("further"))
        moved = cut_lineage(lowered.join(jump, "component").select(
            "id", "before", F.least("component", "further").alias("component")))
        label = moved.select("id", "component")
        if moved.filter("before <> component").isEmpty():
            return label


def alias_table(dimension: DataFrame) -> DataFrame:
    """``(id, component, canonical, members)`` of every station that was ever renumbered.

    The canonical id is the smallest member in use, else the largest member;
    ``members`` is their number.
    """
    grouped = components(links(dimension))
    in_use = (dimension.filter("is_active")
              .select(F.trim("id").alias("id"), F.lit(True).alias("in_use")).distinct())
    marked = grouped.join(in_use, "id", "left")
    chosen = marked.groupBy("component").agg(
        F.coalesce(F.min(F.when(F.col("in_use"), F.col("id"))), F.max("id")).alias("canonical"),
        F.count(F.lit(1)).alias("members"))
    return cut_lineage(grouped.join(chosen, "component")
                       .select("id", "component", "canonical", "members"))


def asked_ids(alias_or_rows: DataFrame, ids: Sequence[str]) -> DataFrame:
    """A request's ids as rows ``(position, asked)``."""
    return alias_or_rows.sparkSession.createDataFrame(
        list(enumerate(ids)), "position int, asked string")


def expansion(alias: DataFrame, asked: DataFrame) -> DataFrame:
    """``(id, asked, position)`` of the asked ids and their aliases, for any number of them.

    An id that was asked for itself stays attributed to itself; an alias belongs to
    the last asked id of its group, the larger of two at one position. Each group is one row before it spreads to its
    members, so the work grows with members plus asked ids.
    """
    own = asked.groupBy("asked").agg(F.max("position").alias("position"))
    last = (own.join(alias, own["asked"] == alias["id"]).groupBy("component")
            .agg(F.max_by("asked", F.struct("position", "asked")).alias("asked"), F.max("position").alias("position")))
    others = (alias.join(last, "component").select("id", "asked", "position")
              .join(own.select(F.col("asked").alias("id")), "id", "left_anti"))
    return own.select(F.col("asked").alias("id"), "asked", "position").unionByName(others)


class AliasIndex:
    """The alias table held on the driver, so that a request needs no job to resolve its ids.

    It is made from the station dimension and no larger; beyond ``most`` rows it is not held,
    and each request joins its ids instead.
    """

    def __init__(self, table: DataFrame, most: int = 200_000):
        self.table = table
        held = table.select("id", "component").limit(most + 1).collect()
        self.component = {r["id"]: r["component"] for r in held} if len(held) <= most else None
        self.members: dict[str, list[str]] = {}
        for station, component in (self.component or {}).items():
            self.members.setdefault(component, []).append(station)

    def request_ids(self, ids: Sequence[str]) -> list[tuple[str, str]]:
        """As :func:`request_ids` of the table."""
        if self.component is None:
            return request_ids(self.table, ids)
        position = {station: at for at, station in enumerate(ids)}
        last: dict[str, tuple[int, str]] = {}
        for station, at in position.items():
            component = self.component.get(station)
            if component is not None:
                last[component] = max(last.get(component, (at, station)), (at, station))
        found = [(at, False, station, station) for station, at in position.items()]
        found += [(at, True, station, asked) for component, (at, asked) in last.items()
                  for station in self.members[component] if station not in position]
        return [(station, asked) for _, _, station, asked in sorted(found)]


def request_ids(alias: DataFrame | AliasIndex | None, ids: Sequence[str]) -> list[tuple[str, str]]:
    """``(id, asked)`` of a request in its order, an asked id before its aliases.

    They come to the driver: the request is there already, and its aliases are no
    more than the station dimension holds.
    """
    if alias is None:
        return [(station, station) for station in dict.fromkeys(ids)]
    if isinstance(alias, AliasIndex):
        return alias.request_ids(ids)
    found = expansion(alias, asked_ids(alias, ids))
    return [(row["id"], row["asked"]) for row in found.orderBy(
        "position", F.col("id") != F.col("asked"), "id").collect()]


def attribute(df: DataFrame, alias: DataFrame | AliasIndex | None, ids: Sequence[str],
              column: str = "GantryID") -> DataFrame:
    """Rows of the asked stations and their aliases, alias ids rewritten to the asked id.

    The ids are a filter that reaches the Parquet scan; new names are joined.
    """
    found = request_ids(alias, ids)
    kept = df.filter(F.col(column).isin([station for station, _ in found]))
    renamed = [(station, asked) for station, asked in found if station != asked]
    if not renamed:
        return kept
    names = df.sparkSession.createDataFrame(renamed, f"{column} string, asked string")
    return kept.join(names, column, "left").withColumn(
        column, F.coalesce("asked", column)).drop("asked").select(*df.columns)


def expanded_ids(alias: DataFrame | AliasIndex | None, *lists: Sequence[str]) -> list[list[str]]:
    """Each list of asked ids with their aliases, in request order, for path patterns."""
    return [[station for station, _ in request_ids(alias, ids)] for ids in lists]
