"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadpulse.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes in ``links`` (a, b: long); the component is its least node.

    Each round hangs the neighbours of a node under the least of them, first the larger and
    then the smaller ones, and writes the links to the shared folder. Groupings combine
    before their shuffle. Loops and null ends are left out.
    """
    links = cut_lineage(links.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").where("b > a") \
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(least.select("a", F.col("m").alias("b")))
        links = cut_lineage(small.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        row = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"),
                        F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
