"""Whole texts as byte arrays: chunks of Arrow batches, words, hashes of windows, anchors.

Every helper works on a chunk: the UTF-8 bytes of some documents laid end to end with
their offsets. Null texts count as empty. A chunk holds about ``CHUNK`` bytes, or one
document if that alone is longer.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)


_forgotten: list[Callable[[], None]] = []
_last_user = ""


def remembers(forget: Callable[[], None]) -> None:
    """Register what empties a worker's cache when another operator takes the worker over."""
    _forgotten.append(forget)


def begin(user: str) -> None:
    """Start of a task. Workers serve many tasks: caches stay for those of one operator only."""
    global _last_user
    if _last_user not in ("", user):
        for forget in _forgotten:
            forget()
        Rolling.forget()
        gc.collect()
        give_back()
    _last_user = user


def give_back() -> None:
    """Return freed memory to the system, which both allocators would keep for later."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``limit`` text bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False)
        begin, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += size
        if begin < batch.num_rows:
            yield batch.slice(begin)
    give_back()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each (one more than texts)."""
    array = pc.fill_null(array.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    raw = array.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw and raw.size else \
        np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of the first word of each text."""
    inside = ~is_space(data)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = offsets[:-1][offsets[:-1] < len(data)]
    first[at] |= inside[at]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    at = offsets[1:][offsets[1:] > 0] - 1
    last[at] |= inside[at]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit values with every bit depending on all bits."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values


class Rolling:
    """Hashes of any stretch of a sequence, from sums of values times powers.

    ``seed`` selects one of the independent hash functions.
    """

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, values: np.ndarray, seed: int = 0):
        base = (0x9E3779B97F4A7C15 * (2 * seed + 3)) | 1
        power, inverse = self._table(base, len(values) + 1)
        if values.dtype == np.uint8:
            letters = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * seed)) * _ODD)
            values = letters[values]
        else:
            values = mixed(values + np.uint64(seed * int(_ODD) & (1 << 64) - 1))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[:len(values)], out=self.sums[1:])
        self.inverse = inverse

    @classmethod
    def forget(cls) -> None:
        cls._powers.clear()

    @classmethod
    def _table(cls, base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        held = cls._powers.get(base)
        if held is None or len(held[0]) < size:
            size = max(size, 1 << 16)
            back = pow(base, -1, 1 << 64)
            both = []
            for step in (base, back):
                out = np.full(size, np.uint64(step & (2 ** 64 - 1)))
                out[0] = 1
                both.append(np.multiply.accumulate(out))
            held = cls._powers[base] = tuple(both)
            if len(cls._powers) > 4:
                cls._powers.pop(next(iter(cls._powers)))
        return held

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def every(self, length: int) -> np.ndarray:
        """Hashes of all stretches of ``length``, by start."""
        if len(self.sums) <= length:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[length:] - self.sums[:-length])
                     * self.inverse[:len(self.sums) - length])


def starts_of(offsets: np.ndarray, length: int) -> np.ndarray:
    """All positions at which ``length`` units of one text start."""
    fits = np.maximum(np.diff(offsets) - length + 1, 0)
    total = int(fits.sum())
    before = np.cumsum(fits) - fits
    return np.arange(total) + np.repeat(offsets[:-1] - before, fits)


def anchors(grams: np.ndarray, offsets: np.ndarray, length: int,
            span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For windows of ``length`` units, the smallest of their ``span`` gram hashes.

    ``grams`` has the hash of the gram at each unit; a window holds ``span`` gram starts.
    Equal windows choose the same gram at the same place, wherever they stand. Returns
    (anchor position, first and last window start that chose it), each window once.
    """
    starts = starts_of(offsets, length)
    none = np.zeros(0, np.int64)
    if not len(starts):
        return none, none, none
    bits = np.uint64(max(1, int(len(grams)).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    wide = 1
    while 2 * wide <= span:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if wide < span:
        rest = span - wide
        least = np.minimum(least[:-rest], least[rest:])
    chosen = (least[starts] & low).astype(np.int64)
    new = np.ones(len(chosen), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    final = np.append(first[1:], len(chosen)) - 1
    return chosen[first], starts[first], starts[final]


def sums_by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets."""
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
