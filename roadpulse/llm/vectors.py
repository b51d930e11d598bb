"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, components.

Equal vectors of a label are one member with a weight. Members go to the cell of their
nearest centroid, and copies of them to every cell of a lower number in which a partner
could be: if x and y have a cosine of ``least`` or more, their unit vectors are at most
sqrt(2 - 2 least) apart, so x lies no further than that behind the plane between the two
centroids. So no link is lost, whatever the centroids; they only decide the work. They
are fitted on at most ``sample`` vectors, those with the smallest hash.

A cell is compared in blocks of ``BLOCK`` members, each pair of blocks in a task of its own,
which returns link counts and a spanning forest instead of all pairs.

Vectors that are null, zero or of no component, or hold null or non-finite components, and
vectors without label link with nothing. Vectors of different sizes never link. Rows of one
id count as different vectors. Columns of the result's names are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadpulse.llm import texts
from roadpulse.llm.components import components
from roadpulse.session import cut_lineage

SAMPLE = 20_000
BLOCK = 1024
#: Members of all labels for one centroid, and the most centroids.
PER_CELL, MOST_CELLS = 20_000, 4096


def spherical_kmeans(points: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Unit centroids of unit vectors."""
    random = np.random.default_rng(seed)
    centers = points[random.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds if len(centers) > 1 else 0):
        near = np.argmax(points @ centers.T, axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, points)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centers)
    return centers


def _matrix(array: pa.Array) -> np.ndarray:
    return array.flatten().to_numpy(zero_copy_only=False).astype(np.float64) \
        .reshape(len(array), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric link matrix."""
    waiting = linked.any(axis=1)
    out = []
    for root in range(len(linked)):
        if not waiting[root]:
            continue
        waiting[root] = False
        stack = [root]
        while stack:
            at = stack.pop()
            fresh = np.flatnonzero(linked[at] & waiting)
            waiting[fresh] = False
            out += [(at, x) for x in fresh.tolist()]
            stack += fresh.tolist()
    return out


def near_duplicates(vectors: DataFrame, least: float = 0.98, sample: int = SAMPLE,
                    per_cell: int = PER_CELL, block: int = BLOCK) -> DataFrame:
    """``vectors`` with ``n_links``, ``component_id`` and ``kept``.

    ``vectors`` needs vec_id, embedding and label.
    """
    vectors = vectors.drop("n_links", "component_id", "kept")
    spark = vectors.sparkSession
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() \
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                   & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    alike = ["label", "embedding"]
    classes = cut_lineage(vectors.where(usable).groupBy(alike).agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("first"))
        .withColumn("node", F.xxhash64("label", "embedding")))
    number = classes.count()
    size_of = F.size("embedding")
    sizes = classes.groupBy(size_of.alias("d")).count().orderBy(F.desc("count"), "d").first()
    centers = np.zeros((0, 0))
    if number:
        picked = classes.where(size_of == sizes["d"]).orderBy("node").limit(sample) \
            .select("embedding").toArrow()["embedding"].combine_chunks()
        centers = spherical_kmeans(_unit(_matrix(picked)),
                                   min(MOST_CELLS, max(1, number // per_cell)))
    shared = spark.sparkContext.broadcast(centers)
    reach = (2 - 2 * least) ** 0.5 + 1e-9

    def dealt(batches):
        centers = shared.value
        apart = np.linalg.norm(centers[:, None] - centers[None], axis=2) if len(centers) else None
        for batch in batches:
            dims = texts.column(batch, "embedding").value_lengths().to_numpy()
            n = len(dims)
            home, row, cell = np.zeros(n, np.int64), [np.arange(n)], []
            main = np.flatnonzero(dims == centers.shape[1]) if len(centers) > 1 else []
            if len(main):
                x = _unit(_matrix(texts.column(batch, "embedding").take(pa.array(main))))
                near = x @ centers.T
                home[main] = near.argmax(axis=1)
                own = home[main]
                behind = near[np.arange(len(main)), own][:, None] - near
                may = (behind <= reach * apart[own]) & (np.arange(len(centers)) < own[:, None])
                copy, to = np.nonzero(may)
                row.append(main[copy])
                cell.append(to)
            cell, row = np.concatenate([home, *cell]), np.concatenate(row)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell), pa.array(home[row] == cell), pa.array(dims[row]),
                 *(texts.column(batch, c).take(take)
                   for c in ("label", "node", "weight", "embedding"))],
                ["cell", "home", "d", "label", "node", "weight", "embedding"])

    label = classes.schema["label"].dataType.simpleString()
    vector = classes.schema["embedding"].dataType.simpleString()
    members = cut_lineage(classes.select("label", "node", "weight", "embedding").mapInArrow(
        dealt, f"cell long, home boolean, d int, label {label}, node long, weight long, "
               f"embedding {vector}"))
    key = ["label", "d", "cell"]
    blocks = members.groupBy(key).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    pairs = members.join(blocks, key).withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks"))) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumn("lo", F.least("b", "other")).withColumn("hi", F.greatest("b", "other")) \
        .select(*key, "lo", "hi", "b", "home", "node", "weight", "embedding")

    def compared(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, weight = table["node"].to_numpy(), table["weight"].to_numpy()
        home, b = table["home"].to_numpy(), table["b"].to_numpy()
        x = _matrix(table["embedding"].combine_chunks())
        x = x / np.abs(x).max(axis=1, keepdims=True)
        norm = np.linalg.norm(x, axis=1)
        linked = (x @ x.T) / norm[:, None] / norm[None] >= least
        linked &= home[:, None] | home[None]
        lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
        if lo != hi:
            linked &= b[:, None] != b[None]
        np.fill_diagonal(linked, False)
        linked |= linked.T
        counts = linked @ weight.astype(np.float64)
        hit = np.flatnonzero(counts)
        edges = np.array(forest(linked), np.int64).reshape(-1, 2)
        return pa.table({
            "a": np.concatenate([node[hit], node[edges[:, 0]]]),
            "b": pa.array(np.concatenate([np.zeros(len(hit), np.int64), node[edges[:, 1]]]),
                          mask=np.arange(len(hit) + len(edges)) < len(hit)),
            "links": np.concatenate([counts[hit].astype(np.int64), np.zeros(len(edges), np.int64)])})

    found = cut_lineage(pairs.groupBy(*key, "lo", "hi").applyInArrow(
        compared, "a long, b long, links long"))
    links = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(
        F.sum("links").alias("links"))
    joined = classes.join(links, "node", "left").join(
        components(found.where("b IS NOT NULL").select("a", "b")), "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    heads = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = joined.join(heads, "component").select(
        *alike, (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        "component_id")
    by = [vectors[c] == classes[c] for c in alike]
    return vectors.join(classes, by[0] & by[1], "left").select(
        *(vectors[c] for c in vectors.columns),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", vectors["vec_id"]).alias("component_id"),
        F.coalesce(vectors["vec_id"] == F.coalesce("component_id", vectors["vec_id"]),
                   F.lit(True)).alias("kept"))
