"""Near-duplicate texts by order MinHash, verified by banded alignment.

Words are the runs of letters, digits and non-ASCII bytes, in lower case (A-Z). The k-mers
are shingles of five words, each labelled with the number of its occurrence, so that a
repeated shingle counts as often as it stands. A sketch takes the ``TAKEN`` shingles with
the least hashes and keeps their order in the text: texts share it if they have these
shingles in this order, so it follows edit similarity and not only the set. Texts that share
one of ``SKETCHES`` are candidates. Two texts of similarity 0.8 share a given sketch with a
chance near one half, so all 24 fail with one of about 4e-8.

Candidates are verified exactly: the shingles of both are aligned, in a band as wide as the
threshold allows, and the similarity is matched / (all of both - matched). Texts linked at
``least`` or more, directly or over others, form a class.

Texts with the same words are one member. Sketches with the same members are checked once.
A task gets the members of one sketch value, as word hashes, in blocks of ``BLOCK``: larger
groups go to one task for each pair of blocks. It first bounds similarities by the shared
shingles (matrix products over those that several members hold), then aligns what is left
unless already connected. It returns edges of a spanning forest, never all pairs.

Texts with fewer than five words are one shingle; texts without words are alike only if
equal byte by byte, and empty or null ones belong to no group. Rows with a null id are kept
and belong to none. Rows of the same id and words count as copies. Columns of the result's
names are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadpulse.llm import texts
from roadpulse.llm.components import components
from roadpulse.llm.substrings import tagged
from roadpulse.session import cut_lineage

WORDS = 5
SKETCHES, TAKEN = 24, 3
BLOCK = 8000
_PLAIN = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32
                   for b in range(256)], np.uint8)


def _shingles(word: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-labelled shingle hashes of all texts, and the cuts between texts."""
    n = np.diff(bounds)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    cuts = np.append(0, np.cumsum(count))
    starts = np.arange(cuts[-1]) + np.repeat(bounds[:-1] - cuts[:-1], count)
    ends = np.minimum(starts + size, np.repeat(bounds[1:], count))
    hashes = texts.Rolling(word, 3).of(starts, ends)
    own = np.repeat(np.arange(len(n)), count)
    order = np.lexsort((hashes, own))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (own[order][1:] != own[order][:-1])
    first = np.flatnonzero(new)
    occurrence = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    hashes[order] = texts.mixed(hashes[order] + occurrence.astype(np.uint64)
                                * np.uint64(0x9E3779B97F4A7C15))
    return hashes, cuts


def _plain_words(batch: pa.RecordBatch):
    data, offsets = texts.text_bytes(texts.column(batch, "text"))
    data = _PLAIN[data]
    starts, ends, bounds = texts.words(data, offsets)
    word = texts.Rolling(data).of(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return word, bounds


def order_sketches(hashes: np.ndarray, sketches: int = SKETCHES, taken: int = TAKEN) -> np.ndarray:
    """One number for each sketch of a text with these labelled shingles."""
    odd = (np.arange(1, sketches + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
    mixed = hashes[None, :] * odd[:, None]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    if hashes.size > taken:
        least = np.sort(np.argpartition(mixed, taken - 1, axis=1)[:, :taken], axis=1)
        mixed = np.take_along_axis(mixed, least, axis=1)
    out = np.arange(1, sketches + 1, dtype=np.uint64)
    for k in range(mixed.shape[1]):
        out = texts.mixed(out * np.uint64(0x9E3779B97F4A7C15) + mixed[:, k])
    return out.view(np.int64)


def aligned(one: np.ndarray, others: list[np.ndarray], least: float) -> np.ndarray:
    """Whether the similarity of ``one`` with each of ``others`` reaches ``least``.

    The longest common subsequence of shingles, row by row over a band; a text can leave the
    diagonal only by as many shingles as the threshold lets go unmatched.
    """
    n, sizes = len(one), np.array([len(x) for x in others])
    need = np.ceil(least / (1 + least) * (n + sizes) - 1e-9)
    wide = int(max(0, (np.maximum(n, sizes) - need).max()))
    width = int(sizes.max())
    padded = np.zeros((len(others), wide + max(width, n) + wide + 2), np.uint64)
    for k, other in enumerate(others):
        padded[k, wide:wide + len(other)] = other
    # State by diagonal: matches so far with the other text read up to row + k - wide.
    best = np.zeros((len(others), 2 * wide + 2), np.int32)
    for row in range(n):
        same = padded[:, row:row + 2 * wide + 1] == one[row]
        step = best[:, :-1] + same
        np.maximum(step, best[:, 1:], out=step)
        np.maximum.accumulate(step, axis=1, out=best[:, :-1])
        best[:, -1] = best[:, -2]
    # The band is left at the diagonal of each text's end; wider ends hold no more matches.
    return best[:, :-1].max(axis=1) >= need


class Sets:
    """Disjoint sets of numbers."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return int(x)

    def tops(self) -> np.ndarray:
        while (self.up[self.up] != self.up).any():
            self.up = self.up[self.up]
        return self.up


def verified(lists: list[np.ndarray], groups: np.ndarray, across: bool,
             least: float) -> list[tuple[int, int]]:
    """Forest edges among members with the given shingles; ``across``: only between groups."""
    n = len(lists)
    sizes = np.array([len(x) for x in lists])
    flat = np.concatenate(lists)
    own = np.repeat(np.arange(n), sizes)
    _, number, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[number] > 1
    renumbered = np.cumsum(times > 1) - 1
    column = renumbered[number]
    width = int((times > 1).sum())
    sets, out = Sets(n), []
    # Shingles of one text that share a short hash count once below; the bound makes up for it.
    held = np.unique(own * len(times) + number) // max(1, len(times))
    twins = sizes - np.bincount(held, minlength=n)
    rows = 256
    for begin in range(0, n, rows):
        end = min(n, begin + rows)
        overlap = np.zeros((end - begin, n), np.float32)
        # Columns in stretches, so that the matrices stay small however many shingles there are.
        for low in range(0, width, 1000):
            inside = shared & (column >= low) & (column < low + 1000)
            matrix = np.zeros((n, min(1000, width - low)), np.float32)
            matrix[own[inside], column[inside] - low] = 1
            overlap += matrix[begin:end] @ matrix.T
        overlap += twins[begin:end, None] + twins[None]
        bound = overlap / (sizes[begin:end, None] + sizes[None] - overlap)
        for i in range(begin, end):
            near = bound[i - begin] >= least - 1e-6
            near[:i + 1] = False
            if across:
                near &= groups != groups[i]
            partners = np.flatnonzero(near)
            if not len(partners):
                continue
            tops = sets.tops()
            partners = partners[tops[partners] != tops[i]]
            partners = partners[np.argsort(sizes[partners], kind="stable")]
            at = 0
            while at < len(partners):
                # About 2 million cells of the band at a time.
                slack = max(8, int(0.25 * max(sizes[i], sizes[partners[at]])))
                step = max(1, min(256, 2_000_000 // slack // 8))
                part = [int(p) for p in partners[at:at + step] if sets.top(int(p)) != sets.top(i)]
                at += step
                if not part:
                    continue
                for p, ok in zip(part, aligned(lists[i], [lists[p] for p in part], least)):
                    if ok and sets.top(p) != sets.top(i):
                        sets.up[sets.top(p)] = sets.top(i)
                        out.append((i, p))
    return out


def near_duplicates(docs: DataFrame, least: float = 0.8, size: int = WORDS,
                    block: int = BLOCK) -> DataFrame:
    """(doc_id, tag, class_id, n_copies, kept) for each row with an id.

    ``class_id`` is the least id of the class, ``n_copies`` the number of its rows; ``kept``
    marks the rows of that id. ``tag`` is a hash of the text.
    """
    docs = tagged(docs).where("doc_id IS NOT NULL")

    def sketched(batches):
        texts.begin("order_minhash")
        for batch in texts.chunks(batches):
            word, bounds = _plain_words(batch)
            hashes, cuts = _shingles(word, bounds, size)
            n = len(bounds) - 1
            whole = texts.Rolling(word, 4)
            tag = texts.column(batch, "tag").to_numpy()
            key = whole.of(bounds[:-1], bounds[1:]) + np.diff(bounds).astype(np.uint64)
            key = np.where(np.diff(bounds) > 0, key.view(np.int64), tag)
            length = np.diff(texts.text_bytes(texts.column(batch, "text"))[1])
            bands = [order_sketches(hashes[a:b]) if b > a else np.zeros(0, np.int64)
                     for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum([len(b) for b in bands])), pa.int32()),
                pa.array(np.concatenate(bands) if bands else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [texts.column(batch, "doc_id"), texts.column(batch, "tag"),
                 pa.array(key, mask=length == 0), lists],
                ["doc_id", "tag", "node", "sketches"])

    rows = cut_lineage(docs.mapInArrow(
        sketched, "doc_id long, tag long, node long, sketches array<long>"))
    members = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct("doc_id", "tag")).alias("first"), F.count("*").alias("rows"),
        F.first("sketches").alias("sketches"))
    members = cut_lineage(members)
    dealt = members.select("node", F.explode("sketches").alias("sketch"))
    alike = dealt.groupBy("sketch").agg(
        F.count("*").alias("n"), F.expr("bit_xor(xxhash64(node))").alias("x"),
        F.expr("bit_xor(xxhash64(node, 1))").alias("y")).where("n > 1")
    once = cut_lineage(alike.groupBy("n", "x", "y").agg(F.min("sketch").alias("sketch"))
                       .select("sketch", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    found = cut_lineage(dealt.join(once, "sketch").withColumn(
        "b", F.pmod(F.xxhash64("node"), F.col("blocks"))))
    wanted = found.select("node").distinct().join(members, "node") \
        .select("node", "first.doc_id", "first.tag")

    def hashed(batches):
        texts.begin("order_minhash")
        for batch in texts.chunks(batches):
            word, bounds = _plain_words(batch)
            hashes, cuts = _shingles(word, bounds, size)
            # Four bytes a shingle are enough to align; candidates share far longer hashes.
            raw = (hashes >> np.uint64(32)).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [texts.column(batch, "node"), pa.Array.from_buffers(
                    pa.binary(), len(cuts) - 1, [None, pa.py_buffer((4 * cuts).astype(np.int32)),
                                                 pa.py_buffer(raw.tobytes())])],
                ["node", "shingles"])

    contents = cut_lineage(docs.join(wanted.hint("shuffle_hash"), ["doc_id", "tag"])
                           .select("node", "text").mapInArrow(hashed, "node long, shingles binary")
                           .dropDuplicates(["node"]))
    groups = found.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("sketch", "node", "b", F.least("b", "other").alias("lo"),
                F.greatest("b", "other").alias("hi")).join(contents, "node")

    def compared(table: pa.Table) -> pa.Table:
        node, b = table["node"].to_numpy(), table["b"].to_numpy()
        lists = [np.frombuffer(x, "<u4").astype(np.uint64) + np.uint64(1)
                 for x in table["shingles"].to_pylist()]
        across = table["lo"][0].as_py() != table["hi"][0].as_py()
        edges = np.array(verified(lists, b, across, least), np.int64).reshape(-1, 2)
        return pa.table({"a": node[edges[:, 0]], "b": node[edges[:, 1]]})

    links = groups.groupBy("sketch", "lo", "hi").applyInArrow(compared, "a long, b long")
    joined = members.select("node", "first.doc_id", "rows").join(components(links), "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    heads = joined.groupBy("component").agg(F.min("doc_id").alias("class_id"),
                                            F.sum("rows").alias("n_copies"))
    classes = joined.join(heads, "component").select("node", "class_id", "n_copies")
    return rows.drop("sketches").join(classes, "node", "left").select(
        "doc_id", "tag", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        (F.col("doc_id") == F.coalesce("class_id", "doc_id")).alias("kept"))


def keep_one(docs: DataFrame, least: float = 0.8, size: int = WORDS) -> DataFrame:
    """``docs`` with one row of each class, that of the least id; rows without id stay.

    Rows that repeat one id stay once, unless their words differ too much to be copies.
    """
    marks = near_duplicates(docs, least, size).where("kept").select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        F.col("tag").alias("__tag")).distinct()
    known = docs.where("doc_id IS NOT NULL").withColumn("__tag", F.xxhash64("text"))
    # One shuffle of the texts serves the join and the repeated rows.
    kept = known.join(marks.hint("shuffle_hash"), ["doc_id", "__tag"], "left_semi") \
        .dropDuplicates(["doc_id", "__tag"]).select(docs.columns)
    return kept.unionByName(docs.where("doc_id IS NULL"))
