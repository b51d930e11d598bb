"""Filter interaction audit: what each filter removes at each place of each order.

A document's failures are a set of filters, so the whole table shrinks to one count for each
part and failure set. Filters run as a path through the lattice of subsets: state ``S`` is the
set of filters already applied, edge ``(S, f)`` applies ``f`` next and removes the documents
that fail ``f`` and nothing in ``S``. The orders that reach a state and those that leave it
are counted forward and backward over the lattice; their product is the number of orders
through an edge. Weighted with it, the removals of a filter's edges sum to its Shapley value
over all orders, and the steps of an order are read from the edges along it.

Nulls: a null text is an empty one, a null part the empty string; a document without id is
never a later copy and makes none; null, repeated or contradicting labels: a document is good
(toxic) if any label row of its id says so. Rows of one id and one text are separate
documents. Counts are exact for texts of any length; an empty table gives no rows. Extra
columns are ignored.

Copies and labels are found by groupings that combine before their shuffle: rows equal in id,
part and text merge first, so a hot text, id or part is a few rows for each task. Texts
leave the scan as their digests.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window, functions as F

FILTERS = "ABCDE"
_SPACE = r"[\x20\x09-\x0D]+"


def conditions(text: Column) -> dict[str, Column]:
    """Failure conditions that one text decides by itself; ``text`` is not null."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_sets(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, failures, n, good, toxic): documents by the set of filters they fail, as bits."""
    text = F.coalesce("text", F.lit(""))
    bits = sum((F.when(fails, 1 << FILTERS.index(name)).otherwise(0)
                for name, fails in conditions(text).items()), F.lit(0))
    rows = docs.select(
        "doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), bits.alias("bits"),
        F.unhex(F.sha2(text, 256)).alias("digest")) \
        .groupBy("doc_id", "part", "bits", "digest").agg(F.count("*").alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    known = rows.where("doc_id IS NOT NULL").join(marks, "doc_id", "left") \
        .select("doc_id", "part", "bits", "digest", "n",
                F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    nameless = rows.where("doc_id IS NULL").select(
        "doc_id", "part", "bits", "digest", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    # One row for each text, part and label: how many, the least id and how many have that id.
    kinds = known.unionByName(nameless).groupBy("digest", "bits", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNotNull(), F.col("n"))).alias("named"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"))
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    each = kinds.withColumn("first", first)
    at_first = F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(F.lit(0))
    later = (F.coalesce("named", F.lit(0)) - at_first).alias("later")
    split = each.select("part", "good", "toxic", "bits", "n", later).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("bits").alias("failures"), (F.col("n") - F.col("later")).alias("n")),
            F.struct((F.col("bits") + (1 << FILTERS.index("E"))).alias("failures"),
                     F.col("later").alias("n")))).alias("one"))
    count = F.col("one.n")
    return split.groupBy("part", F.col("one.failures").alias("failures")).agg(
        F.sum(count).alias("n"), F.sum(count * F.col("good")).alias("good"),
        F.sum(count * F.col("toxic")).alias("toxic"))


def path_counts(size: int) -> tuple[list[int], list[int]]:
    """Orders that reach each state of the lattice, and orders that lead on from it."""
    states = range(1 << size)
    reach, leave = [0] * len(states), [0] * len(states)
    reach[0] = leave[-1] = 1
    for state in states[1:]:
        reach[state] = sum(reach[state ^ 1 << f] for f in range(size) if state >> f & 1)
    for state in reversed(states[:-1]):
        leave[state] = sum(leave[state | 1 << f] for f in range(size) if not state >> f & 1)
    return reach, leave


def edges(filters: str = FILTERS) -> list[tuple[int, int, int]]:
    """(state, filter, orders through it) of all edges."""
    reach, leave = path_counts(len(filters))
    return [(state, f, reach[state] * leave[state | 1 << f])
            for state in range(1 << len(filters)) for f in range(len(filters)) if not state >> f & 1]


def edge_counts(sets: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row for each part and edge, zeros included, with its removals and what they hold.

    Each of the at most ``2 ** len(filters)`` rows of a part meets the edges by an explode.
    """
    path = F.explode(F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"),
                                        F.lit(w).alias("orders")) for s, f, w in edges(filters)]))
    meets = sets.select("*", path.alias("edge")).select("part", "failures", "n", "good", "toxic", "edge.*")
    bit = F.expr("shiftleft(1, filter)")
    fails = F.col("failures").bitwiseAND(bit) != 0
    clean = F.col("failures").bitwiseAND(F.col("state")) == 0
    def total(column, when):
        return F.sum(F.when(when, F.col(column)).otherwise(0))
    return meets.groupBy("part", "state", "filter", "orders").agg(
        total("n", clean & ~fails).alias("kept"), total("n", clean & fails).alias("removed"),
        total("n", ~clean & fails).alias("redundant"),
        total("n", F.col("failures") == bit).alias("unique_fails"),
        total("good", clean & fails).alias("good_lost"),
        total("toxic", clean & fails).alias("toxic_lost"))


def shapley(by_edge: DataFrame) -> DataFrame:
    """(part, filter, shapley): removals of each filter, summed over all orders."""
    return by_edge.groupBy("part", "filter").agg(
        F.sum(F.col("removed") * F.col("orders")).alias("shapley"))


def steps(by_edge: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row for each part, order and step, read from the edges on the way."""
    through: dict[tuple[int, int], list[tuple[str, int]]] = {}
    for order in permutations(range(len(filters))):
        state = 0
        for step, f in enumerate(order, 1):
            through.setdefault((state, f), []).append(("".join(filters[g] for g in order), step))
            state |= 1 << f
    spark = by_edge.sparkSession
    ways = spark.createDataFrame([(s, f, o, k) for (s, f), on in through.items() for o, k in on],
                                 "state int, filter int, filter_order string, step int")
    return by_edge.join(ways, ["state", "filter"]).join(shapley(by_edge), ["part", "filter"])


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """All steps of all orders of the five filters, for each part."""
    return steps(edge_counts(failure_sets(docs, labels, part))).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley")
