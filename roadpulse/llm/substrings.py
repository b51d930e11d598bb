"""Repeated word windows: a count-min prefilter, then exact grouping of what it lets pass.

Each window of ``length`` words owns an anchor, the smallest hash among its grams of
``gram`` words; equal windows own equal anchors at the same place. The first pass counts
anchors in merged partition sketches, which overestimate how often a window occurs. The
second pass sends only the windows whose anchor may be repeated, all windows of one anchor
in one row, to the task of that anchor, and groups them there by their 128-bit content hash
(64 bits of the anchor, 64 of the window). An anchor with more than ``LARGE`` rows is not
held by its task but passed on, and grouped window by window with an aggregate and a join.

A word is removed if a window that covers it occurs more than once. Rows count as separate
documents, also if they are repeated. Null and empty texts have no words; texts shorter
than the window lose nothing. Columns of the result's names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadpulse.llm import sketch, texts
from roadpulse.session import cut_lineage

LENGTH, GRAM = 35, 10
LARGE = 200_000


def tagged(docs: DataFrame) -> DataFrame:
    """``doc_id`` and text with a hash of the text, which tells rows of one id apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("tag"), F.coalesce("text", F.lit("")).alias("text"))


def text_size(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def _anchored(batch: pa.RecordBatch, length: int, gram: int):
    """(word hashes, anchor hashes and (position, first, last) in words, first word by text)."""
    data, offsets = texts.text_bytes(texts.column(batch, "text"))
    starts, ends, bounds = texts.words(data, offsets)
    if len(starts) < length:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), (none, none, none), bounds
    word = texts.Rolling(data).of(starts, ends)
    grams = texts.Rolling(word, 1).every(gram)
    grams = np.concatenate([grams, np.zeros(gram - 1, np.uint64)])
    found = texts.anchors(grams, bounds, length, length - gram + 1)
    return word, grams[found[0]], found, bounds


def groups(batches: Iterator[pa.RecordBatch], least: int,
           large: int) -> Iterator[tuple[pa.Table, bool]]:
    """Rows sorted by ``h`` as tables of whole groups, of about ``least`` rows, and False.

    A group that grows over ``large`` rows comes in parts instead, each with True.
    """
    held, size, hot = [], 0, None
    for batch in batches:
        if hot is not None:
            h = texts.column(batch, "h").to_numpy()
            same = int(np.searchsorted(h, hot, side="right"))
            if same:
                yield pa.Table.from_batches([batch.slice(0, same)]), True
            if same == batch.num_rows:
                continue
            batch, hot = batch.slice(same), None
        held.append(batch)
        size += batch.num_rows
        if size < least:
            continue
        whole = pa.Table.from_batches(held).combine_chunks()
        h = whole["h"].to_numpy()
        cut = int(np.searchsorted(h, h[-1]))
        if cut:
            yield whole.slice(0, cut), False
        held, size = whole.slice(cut).to_batches(), whole.num_rows - cut
        if size > large:
            yield whole.slice(cut), True
            held, size, hot = [], 0, h[-1]
    if size:
        yield pa.Table.from_batches(held).combine_chunks(), False


#: What a task that groups anchors returns: spans, packed, and strings of anchors too large.
FOUND = "doc_id long, tag long, span long, string binary"
_SHIFT = 20


def pack(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A span as one number; spans are shorter than 2 ** 20."""
    return (first << _SHIFT) | (end - first)


def settled(found: DataFrame, length: int, earliest: bool) -> DataFrame:
    """Spans of ``found``, with those of strings that were too many for a task.

    ``earliest``: the earliest occurrence of a string stays, else none does.
    """
    found = cut_lineage(found)
    spans = found.where("string IS NULL").select("doc_id", "tag", "span")
    strings = found.where("string IS NOT NULL")
    if strings.isEmpty():
        return spans
    place = F.struct(F.coalesce("doc_id", F.lit(-2 ** 63)).alias("d"), "tag", "span")
    if earliest:
        marks = strings.groupBy("string").agg(F.min(place).alias("least"))
        hit = strings.join(marks, "string").where(place > F.col("least"))
    else:
        marks = strings.groupBy("string").count().where("count > 1").select("string")
        hit = strings.join(marks, "string", "left_semi")
    return spans.unionByName(hit.select(
        "doc_id", "tag", (F.shiftleft("span", _SHIFT) + length).alias("span")))


def strings_of(part: pa.Table, firsts: np.ndarray, sizes: np.ndarray,
               strings: list[bytes]) -> pa.RecordBatch:
    """Rows of ``FOUND`` for all strings of too large an anchor."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + firsts[row]
    part = part.combine_chunks()
    take = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [part["doc_id"].combine_chunks().take(take), part["tag"].combine_chunks().take(take),
         pa.array(at), pa.array(strings, pa.binary())], ["doc_id", "tag", "span", "string"])


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
            large: int = LARGE) -> DataFrame:
    """(doc_id, tag, first, end): stretches of words covered by repeated windows."""
    docs = tagged(docs)
    span = length - gram + 1
    bits = sketch.bits_for(text_size(docs) / 6 * 2 / (span + 1))
    bitmaps = sketch.repeated(docs, lambda batch: _anchored(batch, length, gram)[1], bits)
    shared = docs.sparkSession.sparkContext.broadcast(bitmaps)

    def candidates(batches):
        for batch in texts.chunks(batches):
            word, h, (_, first, last), bounds = _anchored(batch, length, gram)
            keep = sketch.may_repeat(shared.value, h) if len(h) else np.zeros(0, bool)
            h, first, last = h[keep], first[keep], last[keep]
            if not len(h):
                continue
            sizes = last - first + 1
            ends = np.cumsum(sizes)
            at = np.arange(ends[-1]) + np.repeat(first - (ends - sizes), sizes)
            window = texts.Rolling(word, 2).of(at, at + length)
            own = np.searchsorted(bounds, first, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), texts.column(batch, "doc_id").take(pa.array(own)),
                 texts.column(batch, "tag").take(pa.array(own)), pa.array(first - bounds[own]),
                 pa.Array.from_buffers(pa.large_binary(), len(h), [
                     None, pa.py_buffer(np.append(0, 8 * ends).astype(np.int64)),
                     pa.py_buffer(window.tobytes())]).cast(pa.binary())],
                ["h", "doc_id", "tag", "first", "windows"])

    rows = docs.mapInArrow(candidates, "h long, doc_id long, tag long, first long, windows binary")

    def found(batches):
        for part, heavy in groups(batches, min(20_000, large), large):
            windows = part["windows"].combine_chunks()
            cuts = np.frombuffer(windows.buffers()[1], np.int32)[windows.offset:][:len(windows) + 1]
            values = np.frombuffer(windows.buffers()[2], np.int64)[cuts[0] // 8:cuts[-1] // 8]
            sizes, cuts = np.diff(cuts) // 8, (cuts - cuts[0]) // 8
            h, first = np.repeat(part["h"].to_numpy(), sizes), part["first"].to_numpy()
            if heavy:
                raw = np.stack([h, values], axis=1).tobytes()
                yield strings_of(part, first, sizes,
                                 [raw[k:k + 16] for k in range(0, len(raw), 16)])
                continue
            start = np.arange(len(values)) + np.repeat(first - cuts[:-1], sizes)
            row = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((values, h))
            same = (values[order][1:] == values[order][:-1]) & (h[order][1:] == h[order][:-1])
            hit = np.zeros(len(values), bool)
            hit[order[1:]] |= same
            hit[order[:-1]] |= same
            at = np.flatnonzero(hit)
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1] + 1) | (row[at][1:] != row[at][:-1])
            begin = at[new]
            final = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1] if len(at) else at
            take = pa.array(row[begin])
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"].combine_chunks().take(take), part["tag"].combine_chunks().take(take),
                 pa.array(pack(start[begin], start[final] + length)),
                 pa.nulls(len(begin), pa.binary())], ["doc_id", "tag", "span", "string"])

    return settled(rows.repartition("h").sortWithinPartitions("h").mapInArrow(found, FOUND),
                   length, False)


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with ``__spans``, the list of packed spans of each row.

    The text goes to the join compressed, as binary ``text``.
    """
    lists = spans.groupBy("doc_id", "tag").agg(F.collect_list("span").alias("__spans")) \
        .withColumnsRenamed({"doc_id": "__id", "tag": "__tag"})
    names = [c for c in docs.columns if c != "text"]

    def small(batches):
        for batch in texts.chunks(batches):
            raw = texts.column(batch, "text").to_pylist()
            packed = [pa.compress(x.encode(), codec="zstd", asbytes=True) if x else None for x in raw]
            sizes = [len(x.encode()) if x else 0 for x in raw]
            yield pa.RecordBatch.from_arrays(
                [*(texts.column(batch, c) for c in [*names, "__key"]), pa.array(packed, pa.binary()),
                 pa.array(sizes, pa.int64())], [*names, "__key", "text", "__size"])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"]
    sent = docs.withColumn("__key", F.xxhash64("text")).mapInArrow(
        small, ", ".join([*types, "__key long", "text binary", "__size long"]))
    return sent.join(lists.hint("shuffle_hash"),
                     sent["doc_id"].cast("long").eqNullSafe(lists["__id"])
                     & (sent["__key"] == lists["__tag"]), "left").drop("__id", "__tag", "__key")


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of ``with_spans`` rows with their texts whole again (empty for null)."""
    for batch in batches:
        sizes, begin, held = texts.column(batch, "__size").to_pylist(), 0, 0
        for row in range(batch.num_rows + 1):
            if row == batch.num_rows or held and held + sizes[row] > texts.CHUNK:
                part = batch.slice(begin, row - begin)
                whole = [pa.decompress(x, decompressed_size=n, codec="zstd", asbytes=True) if x
                         else b"" for x, n in zip(texts.column(part, "text").to_pylist(),
                                                  sizes[begin:row])]
                at = part.schema.get_field_index("text")
                if part.num_rows:
                    yield part.set_column(at, "text", pa.array(whole, pa.large_binary()))
                begin, held = row, 0
            if row < batch.num_rows:
                held += sizes[row]


def covered(batch: pa.RecordBatch, sizes: np.ndarray) -> np.ndarray:
    """For all units of all texts of a batch with span lists: whether a span covers them."""
    cuts = np.append(0, np.cumsum(sizes))
    lists = texts.column(batch, "__spans")
    own = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
    spans = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    first = (spans >> _SHIFT) + cuts[own]
    change = np.bincount(first, minlength=cuts[-1] + 1) \
        - np.bincount(first + (spans & (1 << _SHIFT) - 1), minlength=cuts[-1] + 1)
    return np.cumsum(change)[:-1] > 0


def remove(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
           large: int = LARGE) -> DataFrame:
    """``docs`` with the kept words, joined by one space, as ``text``, and with ``n_words`` and
    ``n_removed``."""
    new = ["n_words", "n_removed"]
    docs = docs.drop(*new)
    names = docs.columns
    joined = with_spans(docs, repeats(docs, length, gram, large))

    def kept(batches):
        for batch in unpacked(batches):
            data, offsets = texts.text_bytes(texts.column(batch, "text"))
            starts, ends, bounds = texts.words(data, offsets)
            gone = covered(batch, np.diff(bounds))
            left = np.flatnonzero(~gone)
            sizes = ends[left] - starts[left] + 1
            out_ends = np.append(0, np.cumsum(sizes))
            source = np.arange(out_ends[-1]) + np.repeat(starts[left] - out_ends[:-1], sizes)
            out = data[np.minimum(source, max(0, len(data) - 1))]
            out[out_ends[1:] - 1] = 32
            # The space after the last word of a text goes.
            number = np.searchsorted(left, bounds)
            full = np.diff(number) > 0
            mask = np.ones(len(out), bool)
            mask[out_ends[number[1:][full]] - 1] = False
            cuts = out_ends[number] - np.append(0, np.cumsum(full))
            text = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [
                None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(out[mask].tobytes())])
            removed = np.diff(np.append(0, np.cumsum(gone))[bounds])
            columns = [text.cast(pa.string()) if n == "text" else texts.column(batch, n)
                       for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.diff(bounds), pa.int64()), pa.array(removed, pa.int64())],
                [*names, *new])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return joined.mapInArrow(kept, ", ".join([*types, "n_words long", "n_removed long"]))
