"""Pages of long answers: an index of key ranges, so that a far page reads its own range only.

An offset makes Spark sort ``offset + limit`` rows into one task. Here the rows of a request are
ranged over all tasks once, and every ``block``-th distinct key is kept with the number of rows
before it. A page then is a range of keys: it is filtered out of the rows (the first key reaches
the Parquet statistics), and at most two blocks and the page itself meet in one task.

Keys cover all columns, so rows equal in them are one row with a count: a row that is repeated
without end is one entry of the index, and a page takes the part of its count that it needs.
Nulls come first, as in an ascending order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from roadpulse.session import cut_lineage

#: Distinct rows between two kept keys.
BLOCK = 10_000
_N = "__n"


def counted(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct rows with their number."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N))


@dataclass
class Pages:
    """Rows in key order, with the stored boundaries ``marks`` (first, before, rows)."""

    rows: DataFrame
    keys: list[str]
    marks: DataFrame

    def total(self) -> int:
        """Rows of all pages, by the index alone."""
        return self.marks.agg(F.sum("rows")).first()[0] or 0

    def key(self, at: Row | None = None) -> Column:
        """The key of a row, or that of a boundary as a literal of the same type."""
        types = self.rows.schema
        return F.struct(*[(F.col(k) if at is None else F.lit(at[k]).cast(types[k].dataType)).alias(k)
                          for k in self.keys])

    def between(self, low: Row, high: Row | None) -> DataFrame:
        """Rows from one boundary up to, without it, the next.

        The conditions on the first key say less than those on the whole key, but reach the scan.
        """
        lead, found = F.col(self.keys[0]), self.rows
        if low[self.keys[0]] is not None:
            found = found.filter(lead >= F.lit(low[self.keys[0]]))
        if high is not None:
            if high[self.keys[0]] is not None:
                found = found.filter(lead.isNull() | (lead <= F.lit(high[self.keys[0]])))
            found = found.filter(self.key() < self.key(high))
        return found.filter(self.key() >= self.key(low))

    def page(self, limit: int, offset: int = 0) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` in key order; behind the last one there are none."""
        if limit < 0 or offset < 0:
            raise ValueError("limit and offset must not be negative")
        start = self.marks.filter(F.col("before") <= offset).orderBy(F.desc("before")).first()
        if start is None or limit == 0:
            return self.rows.select(*self.keys).limit(0)
        stop = self.marks.filter(F.col("before") >= offset + limit).orderBy("before").first()
        found = counted(self.between(start["first"], stop and stop["first"]), self.keys)
        upto = F.lit(start["before"]) + F.sum(_N).over(
            Window.orderBy(*self.keys).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        placed = found.withColumn("__upto", upto)
        first = F.greatest(F.col("__upto") - F.col(_N), F.lit(offset))
        last = F.least(F.col("__upto"), F.lit(offset + limit))
        return placed.filter(first < last).select(
            *self.keys, F.explode(F.sequence(first + 1, last)).alias("__at")
        ).orderBy("__at").drop("__at")


def index(rows: DataFrame, keys: Sequence[str], block: int = BLOCK) -> Pages:
    """The boundaries of all pages, stored in the shared folder; runs when called.

    ``keys`` are all columns, in their order of precedence. Equal rows combine before the
    shuffle; a range then holds about as many distinct rows as any other.
    """
    if sorted(keys) != sorted(rows.columns):
        raise ValueError("keys must be all columns")
    # Both are told while the sorted rows pass: the range in the upper bits, the place below them.
    place = F.monotonically_increasing_id()
    placed = counted(rows, keys).repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        F.struct(*keys).alias("key"), _N, place.alias("place"))
    part, at = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    blocks = cut_lineage(placed.groupBy(part.alias("part"), F.floor(at / block).alias("block")).agg(
        F.min("key").alias("first"), F.sum(_N).alias("rows")))
    parts = blocks.groupBy("part").agg(F.sum("rows").alias("n"))
    # One row for each range in the first window, the blocks of one range in the second.
    base = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    inside = F.sum("rows").over(Window.partitionBy("part").orderBy("block")) - F.col("rows")
    marks = blocks.join(base, "part").select(
        "first", (F.col("base") + inside).alias("before"), "rows")
    return Pages(rows, list(keys), cut_lineage(marks))
