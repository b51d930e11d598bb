"""Routes on the map: coordinates of a driven path, and what to draw without one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.operators.stations import corridor


def route_points(routes: DataFrame, groups_by_station: DataFrame) -> DataFrame:
    """Coordinates along each ``route`` (ids joined by commas), repeats in a row collapsed.

    ``routes`` holds one row per distinct route; a route is as long as one trip.
    """
    listed = routes.select("route", F.posexplode(F.split("route", ",")).alias("at", "station"))
    placed = (listed.join(groups_by_station.select("station", "lat", "lng"), "station")
              .filter(F.col("lat").isNotNull() & F.col("lng").isNotNull()))
    along = Window.partitionBy("route").orderBy("at")
    moved = F.struct("lat", "lng")
    return (placed.withColumn("before", F.lag(moved).over(along))
            .filter(F.col("before").isNull() | (F.col("before") != moved))
            .select("route", F.row_number().over(along).alias("step"), "station", "lat", "lng"))


def drawn_route(pairs: DataFrame, groups: DataFrame, groups_by_station: DataFrame) -> DataFrame:
    """Points to draw for requested pairs (``start_id``, ``end_id``, observed ``route`` or null).

    Nothing if an end has no coordinates. Else the observed path if it has two points,
    else the corridor if it has two, else the two ends.
    """
    keys = ["start_id", "end_id"]
    spot = groups.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull()).select(
        F.col("group_id").alias("end_of"), "lat", "lng")
    for key in keys:
        pairs = pairs.join(spot.select(F.col("end_of").alias(key)), key, "left_semi")
    observed = (pairs.filter(F.col("route").isNotNull())
                .join(route_points(pairs.select("route").filter("route is not null").distinct(),
                                   groups_by_station), "route")
                .select(*keys, "step", "lat", "lng", F.lit(1).alias("choice")))
    along = corridor(groups, pairs).select(*keys, "step", "lat", "lng", F.lit(2).alias("choice"))
    ends = (pairs.select(*keys, F.posexplode(F.array(*keys)).alias("at", "end_of"))
            .join(spot, "end_of")
            .select(*keys, (F.col("at") + 1).alias("step"), "lat", "lng",
                    F.lit(3).alias("choice")))
    options = observed.unionByName(along).unionByName(ends)
    usable = options.groupBy(*keys, "choice").agg(F.count(F.lit(1)).alias("points")).filter(
        "points >= 2").groupBy(*keys).agg(F.min("choice").alias("choice"))
    source = (F.when(F.col("choice") == 1, "observed").when(F.col("choice") == 2, "corridor")
              .otherwise("ends"))
    return options.join(usable, [*keys, "choice"]).select(
        *keys, source.alias("source"), "step", "lat", "lng")
