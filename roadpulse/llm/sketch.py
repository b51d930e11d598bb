"""Count-min sketches of hashed anchors, built by partition, merged by stretches of cells.

Only "once" and "more than once" matter, so counters stop at two. A partition sends the
sorted cells it touched; the merged sketch keeps one bit a cell: counted twice or more. A
hash whose bits are all set may be repeated; one with a bit unset is certainly not.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roadpulse.llm import texts

DEPTH = 2
STRETCH = 18
#: Bounds of log2 of the cells in a row of the sketch. Beyond the upper one a sketch stays at
#: 128 MB a row and lets more hashes pass; none is ever lost.
LEAST_BITS, MOST_BITS = 18, 30


def bits_for(hashes: float) -> int:
    """Four cells for each hash expected."""
    return min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1.0, 4 * hashes)))))


def cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    if row:
        hashes = texts.mixed(hashes + np.uint64(0x9E3779B97F4A7C15 * row & (1 << 64) - 1))
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def repeated(docs: DataFrame, hashes_of: Callable[[pa.RecordBatch], np.ndarray],
             bits: int) -> list[np.ndarray]:
    """The merged sketch over all texts: for each row its bits, packed."""
    stretch = min(STRETCH, bits)

    def packed(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate(parts)
        for row in range(DEPTH):
            found, times = np.unique(cells(hashes, row, bits), return_counts=True)
            cuts = np.searchsorted(found >> stretch, np.arange((1 << bits - stretch) + 1))
            held = np.flatnonzero(np.diff(cuts))
            local = (found & ((1 << stretch) - 1)).astype(np.uint32) * 2 + (times > 1)
            raw = local.astype("<u4").tobytes()
            yield pa.RecordBatch.from_pydict({
                "place": held + (row << bits - stretch),
                "cells": pa.array([raw[4 * cuts[k]:4 * cuts[k + 1]] for k in held], pa.binary())})

    def sketched(batches):
        parts, size = [], 0
        for batch in texts.chunks(batches):
            parts.append(hashes_of(batch))
            size += len(parts[-1])
            if size > 2_000_000:
                yield from packed(parts)
                parts, size = [], 0
        if size:
            yield from packed(parts)

    def merged(batches):
        place, once, more = None, None, None
        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != place:
                    if place is not None:
                        yield bitmap(place, more)
                    place = key
                    once, more = np.zeros(1 << stretch, bool), np.zeros(1 << stretch, bool)
                local = np.frombuffer(raw, "<u4")
                at = local >> 1
                more[at] |= once[at] | ((local & 1) == 1)
                once[at] = True
        if place is not None:
            yield bitmap(place, more)

    def bitmap(place: int, more: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "place": [place],
            "bits": pa.array([np.packbits(more, bitorder="little").tobytes()], pa.binary())})

    rows = docs.mapInArrow(sketched, "place long, cells binary") \
        .repartition("place").sortWithinPartitions("place") \
        .mapInArrow(merged, "place long, bits binary").toArrow()
    out = [np.zeros(1 << bits - 3, np.uint8) for _ in range(DEPTH)]
    size = 1 << stretch - 3
    for place, raw in zip(rows["place"].to_pylist(), rows["bits"]):
        row, at = divmod(place, 1 << bits - stretch)
        out[row][at * size:(at + 1) * size] = np.frombuffer(raw.as_buffer(), np.uint8)
    return out


def may_repeat(sketch: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    bits = int(len(sketch[0])).bit_length() + 2
    out = np.ones(len(hashes), bool)
    for row, held in enumerate(sketch):
        cell = cells(hashes, row, bits)
        out &= (held[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
    return out
