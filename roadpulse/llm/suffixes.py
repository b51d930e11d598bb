"""Maximal repeats of byte strings by common-prefix interval trees over suffix arrays.

Every string of ``length`` bytes owns an anchor, the smallest hash among its grams of
``gram`` bytes, at the same place wherever it stands. A stretch of a text is the union of
neighbouring strings that own the same anchor occurrence; it goes to the task of the
anchor's hash, as the text from the anchor on (its suffix) and the text before it, read
backwards. Sorted by Spark, the rows of an anchor are a suffix array of all places where a
repeat through that anchor can be. With the common prefixes of neighbours it is enhanced,
and a stack scan over them gives the intervals of the prefix tree. Inside an interval,
suffixes are arranged by their left sides: an interval tree over those tells where the left
extensions differ. Each pair of a right and a left interval is a maximal repeat group, and
it holds all its occurrences, not just neighbours. Equal stretches stay one member of the
trees, with the first of them in its place and the others covered by that.

Anchors that stand only once are left out by a count-min sketch. An anchor with more than
``LARGE`` stretches is not held by its task but passed on: its strings are grouped by hash
with an aggregate and joined back.

A byte is removed if a repeated string that also starts earlier covers it; earlier means a
smaller id (null first), then a smaller text hash, then an earlier start. Null and empty
texts have no bytes. Columns of the result's names are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadpulse.llm import sketch, texts
from roadpulse.llm.substrings import (FOUND, covered, groups, pack, settled, strings_of, tagged,
                                      text_size, unpacked, with_spans)
from roadpulse.session import cut_lineage

LENGTH, GRAM = 100, 28
LARGE = 300_000


def _anchored(batch: pa.RecordBatch, length: int, gram: int):
    data, offsets = texts.text_bytes(texts.column(batch, "text"))
    grams = texts.Rolling(data).every(gram)
    grams = np.concatenate([grams, np.zeros(min(len(data), gram - 1), np.uint64)])
    found = texts.anchors(grams, offsets, length, length - gram + 1)
    return data, offsets, grams[found[0]], found


def _binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    cuts = np.append(0, np.cumsum(sizes))
    return pa.Array.from_buffers(pa.binary(), len(sizes), [
        None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(values.tobytes())])


def stretches(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(h, right, left, doc_id, tag, first) of all stretches that may hold a repeat."""
    bits = sketch.bits_for(text_size(docs) * 2 / (length - gram + 2))
    bitmaps = sketch.repeated(docs, lambda batch: _anchored(batch, length, gram)[2], bits)
    shared = docs.sparkSession.sparkContext.broadcast(bitmaps)

    def cut(batches):
        texts.begin("suffixes")
        for batch in texts.chunks(batches):
            data, offsets, h, (at, first, last) = _anchored(batch, length, gram)
            if not len(h):
                continue
            keep = sketch.may_repeat(shared.value, h)
            h, at, first, last = h[keep], at[keep], first[keep], last[keep]
            if not len(h):
                continue
            right, left = last + length - at, at - first
            ends = np.cumsum(right)
            source = np.arange(ends[-1]) + np.repeat(at - (ends - right), right)
            back = np.cumsum(left)
            behind = np.repeat(at - 1 + (back - left), left) - np.arange(back[-1])
            own = np.searchsorted(offsets, first, side="right") - 1
            take = pa.array(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), _binary(data[source], right),
                 _binary(data[behind], left), texts.column(batch, "doc_id").take(take),
                 texts.column(batch, "tag").take(take), pa.array(first - offsets[own])],
                ["h", "right", "left", "doc_id", "tag", "first"])

    return docs.mapInArrow(
        cut, "h long, right binary, left binary, doc_id long, tag long, first long")


def common(array: pa.Array, order: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each string of ``array`` in ``order`` with the one before it."""
    cuts = np.frombuffer(array.buffers()[1], np.int32)[array.offset:][:len(array) + 1].astype(np.int64)
    raw = array.buffers()[2]
    data = np.append(np.frombuffer(raw, np.uint8) if raw and raw.size else
                     np.zeros(0, np.uint8), np.uint8(0))
    out = np.zeros(len(order), np.int64)
    for at in range(1, len(order), 4000):
        two = order[at:at + 4000]
        one = order[at - 1:at - 1 + len(two)]
        sizes = np.minimum(cuts[one + 1] - cuts[one], cuts[two + 1] - cuts[two])
        steps = np.arange(most)
        differ = data[np.minimum(cuts[one][:, None] + steps, len(data) - 1)] != \
            data[np.minimum(cuts[two][:, None] + steps, len(data) - 1)]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), most)
        out[at:at + len(two)] = np.minimum(first, sizes)
    return out


def intervals(common_prefix: list[int], least: int):
    """(prefix length, first, last) of all intervals of a common-prefix array, by a stack scan.

    ``common_prefix[k]`` is that of entries k-1 and k; only lengths from ``least`` count.
    """
    stack: list[tuple[int, int]] = []
    for k in range(1, len(common_prefix) + 1):
        depth = common_prefix[k] if k < len(common_prefix) else -1
        begin = k - 1
        while stack and stack[-1][0] > depth:
            size, begin = stack.pop()
            yield size, begin, k - 1
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, begin))


def shared_prefix(one: bytes, two: bytes) -> int:
    n = min(len(one), len(two))
    differ = int.from_bytes(one[:n], "big") ^ int.from_bytes(two[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def tree_repeats(right_common: list[int], lefts: list[bytes], length: int):
    """(right size, left size, members) of all maximal repeats of ``length`` or more.

    Entries stand in the order of their right sides; ``lefts`` has their left sides, read
    backwards.
    """
    for size, first, last in intervals(right_common, 1):
        if last - first == 1:
            shared = shared_prefix(lefts[first], lefts[last])
            if size + shared >= length:
                yield size, shared, (first, last)
            continue
        members = sorted(range(first, last + 1), key=lefts.__getitem__)
        shared = [0] + [shared_prefix(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        for back, begin, end in intervals(shared, max(0, length - size)):
            yield size, back, members[begin:end + 1]


def repeat_groups(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                  large: int = LARGE) -> DataFrame:
    """Occurrences of maximal repeats, as spans that an earlier occurrence covers.

    (doc_id, tag, span): a stretch of a text, packed, that is the string of a repeat group
    whose first occurrence is elsewhere.
    """
    docs = tagged(docs)

    def scanned(batches):
        texts.begin("suffixes")
        for part, heavy in groups(batches, min(20_000, large), large):
            h = part["h"].to_numpy()
            n = len(h)
            if heavy:
                yield all_strings(part, length)
                continue
            right, left = (part[c].combine_chunks() for c in ("right", "left"))
            sizes_r, sizes_l = (np.diff(np.frombuffer(a.buffers()[1], np.int32)[a.offset:][:n + 1])
                                for a in (right, left))
            shared = common(right, np.arange(n), 2 * length)
            back = common(left, np.arange(n), length)
            new_h = np.ones(n, bool)
            new_h[1:] = h[1:] != h[:-1]
            # Equal stretches: one member each, the first of them.
            new = new_h.copy()
            new[1:] |= (sizes_r[1:] != sizes_r[:-1]) | (shared[1:] != sizes_r[1:]) \
                | (sizes_l[1:] != sizes_l[:-1]) | (back[1:] != sizes_l[1:])
            heads = np.flatnonzero(new)
            member = np.cumsum(new) - 1
            doc = np.array([-2 ** 63 if x is None else x for x in part["doc_id"].to_pylist()])
            tag, at = part["tag"].to_numpy(), part["first"].to_numpy()
            head = heads[member]
            later = (doc != doc[head]) | (tag != tag[head]) | (at != at[head])
            row = np.flatnonzero(later)
            out_row = [row]
            out_span = [pack(at[row], (at + sizes_l + sizes_r)[row])]
            # Trees of the anchors that have several members.
            starts = np.flatnonzero(new_h[heads])
            counts = np.diff(np.append(starts, len(heads)))
            rank = np.empty(n, np.int64)
            rank[np.lexsort((at, tag, doc))] = np.arange(n)
            several = np.zeros(len(heads), bool)
            several[np.repeat(counts > 1, counts)] = True
            chosen = heads[several]
            if len(chosen):
                lefts = left.take(pa.array(chosen)).to_pylist()
                right_of = common(right.take(pa.array(chosen)), np.arange(len(chosen)), 2 * length)
                rows_found, spans = [], []
                base = 0
                for count in counts[counts > 1].tolist():
                    of = slice(base, base + count)
                    prefix = right_of[of].tolist()
                    ranks = rank[chosen[of]].tolist()
                    for size, shared_left, members in tree_repeats(prefix, lefts[of], length):
                        first = min(members, key=ranks.__getitem__)
                        for m in members:
                            if m != first:
                                rows_found.append(base + m)
                                spans.append((shared_left, size))
                    base += count
                if rows_found:
                    row = chosen[np.array(rows_found)]
                    both = np.array(spans)
                    middle = (at + sizes_l)[row]
                    out_row.append(row)
                    out_span.append(pack(middle - both[:, 0], middle + both[:, 1]))
            row = np.concatenate(out_row)
            if len(row):
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"].combine_chunks().take(pa.array(row)), pa.array(tag[row]),
                     pa.array(np.concatenate(out_span)), pa.nulls(len(row), pa.binary())],
                    ["doc_id", "tag", "span", "string"])

    found = stretches(docs, length, gram).repartition("h") \
        .sortWithinPartitions("h", "right", "left", "doc_id", "tag", "first") \
        .mapInArrow(scanned, FOUND)
    return settled(found, length, True)


def group_members(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                  large: int = LARGE) -> DataFrame:
    """(group, doc_id, tag, start, end): repeat groups with all their occurrences, the first as well.

    ``group`` is a digest of the repeated string. A group holds every place of the string in all
    texts, and no longer string around these places has the same members within the reach of their
    anchor. So a repeat that is longer than that reach comes as several groups that overlap; they
    are not joined. Of an anchor with more than ``large`` stretches the groups are single strings
    of ``length`` bytes.
    """
    docs = tagged(docs)

    def rows(part: pa.Table, row: list[np.ndarray], group: list[bytes], start: list[np.ndarray],
             size: list[int]) -> pa.RecordBatch:
        times = [len(x) for x in row]
        at, start = np.concatenate(row), np.concatenate(start)
        names = pa.array(group, pa.binary()).take(pa.array(np.repeat(np.arange(len(group)), times)))
        return pa.RecordBatch.from_arrays(
            [names, *(part[c].combine_chunks().take(pa.array(at)) for c in ("doc_id", "tag")),
             pa.array(start), pa.array(start + np.repeat(size, times)),
             pa.array(np.zeros(len(at), bool))],
            ["group", "doc_id", "tag", "start", "end", "alone"])

    def scanned(batches):
        texts.begin("suffixes")
        for part, heavy in groups(batches, min(20_000, large), large):
            if heavy:
                found = all_strings(part, length)
                first = found.column(2).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [found.column(3), found.column(0), found.column(1), pa.array(first),
                     pa.array(first + length), pa.array(np.ones(len(first), bool))],
                    ["group", "doc_id", "tag", "start", "end", "alone"])
                continue
            h = part["h"].to_numpy()
            right = part["right"].combine_chunks()
            shared = common(right, np.arange(len(h)), 2 * length)
            middle = part["first"].to_numpy() + np.array([len(x) for x in part["left"].to_pylist()])
            cuts = np.flatnonzero(np.append(True, h[1:] != h[:-1])).tolist() + [len(h)]
            held, n_held = ([], [], [], []), 0
            for begin, end in zip(cuts, cuts[1:]):
                if end - begin == 1:
                    continue
                prefix = [0, *shared[begin + 1:end].tolist()]
                lefts = part["left"].slice(begin, end - begin).to_pylist()
                for size, back, members in tree_repeats(prefix, lefts, length):
                    # Members that share more to the right are a group of a smaller interval.
                    if min(prefix[min(members) + 1:max(members) + 1]) > size:
                        continue
                    one = members[0]
                    text = lefts[one][:back][::-1] + right[begin + one].as_py()[:size]
                    name = hashlib.blake2b(text, digest_size=16).digest()
                    row = begin + np.array(members)
                    for values, value in zip(held, (row, name, middle[row] - back, back + size)):
                        values.append(value)
                    n_held += len(row)
                    if n_held > 50_000:
                        yield rows(part, *held)
                        held, n_held = ([], [], [], []), 0
            if n_held:
                yield rows(part, *held)

    found = cut_lineage(stretches(docs, length, gram).repartition("h")
                        .sortWithinPartitions("h", "right", "left", "doc_id", "tag", "first")
                        .mapInArrow(scanned, "group binary, doc_id long, tag long, start long, "
                                             "end long, alone boolean"))
    several = found.where("alone").groupBy("group").count().where("count > 1").select("group")
    return found.where("NOT alone").unionByName(found.where("alone").join(several, "group", "left_semi")) \
        .drop("alone")


def all_strings(part: pa.Table, length: int) -> pa.RecordBatch:
    strings, sizes = [], []
    for right, left in zip(part["right"].to_pylist(), part["left"].to_pylist()):
        text = left[::-1] + right
        sizes.append(len(text) - length + 1)
        strings += [hashlib.blake2b(text[k:k + length], digest_size=16).digest()
                    for k in range(sizes[-1])]
    return strings_of(part, part["first"].to_numpy(), np.array(sizes), strings)


def remove(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
           large: int = LARGE) -> DataFrame:
    """``docs`` with the bytes left over in ``kept`` (binary) and as ``text`` (characters cut
    apart are dropped), and with ``n_bytes``, ``n_removed`` and ``n_spans``."""
    new = ["n_bytes", "n_removed", "n_spans", "kept"]
    docs = docs.drop(*new)
    names = docs.columns
    joined = with_spans(docs, repeat_groups(docs, length, gram, large))

    def kept(batches):
        texts.begin("suffixes")
        for batch in unpacked(batches):
            data, offsets = texts.text_bytes(texts.column(batch, "text"))
            gone = covered(batch, np.diff(offsets))
            begin = gone.copy()
            begin[1:] &= ~gone[:-1]
            at = offsets[:-1][offsets[:-1] < len(gone)]
            begin[at] |= gone[at]
            removed, spans = (np.diff(np.append(0, np.cumsum(x))[offsets]) for x in (gone, begin))
            left = _binary(data[~gone], np.diff(offsets) - removed)
            try:
                text = left.cast(pa.string())
            except pa.ArrowInvalid:
                text = pa.array([x.decode("utf-8", "ignore") for x in left.to_pylist()])
            columns = [text if n == "text" else texts.column(batch, n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, *(pa.array(x, pa.int64()) for x in (np.diff(offsets), removed, spans)),
                 left], [*names, *new])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return joined.mapInArrow(kept, ", ".join(
        [*types, "n_bytes long", "n_removed long", "n_spans long", "kept binary"]))
