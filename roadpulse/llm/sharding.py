"""Sharding: a uniform shuffle into shards of exact sizes, by a random communication matrix.

Rows lie in cells: stretches of at most ``CELL`` rows of one stored file. How many rows each
cell sends to each shard is drawn before any row moves, from the multivariate hypergeometric
law of a uniform shuffle: groups of cells draw from the shard sizes, and the cells of a group
from what their group drew. So every cell sends exactly its rows and every shard receives
exactly its size, at most one row more than another. Within a cell a random permutation
decides which rows go where; then rows are exchanged, and a second permutation of each shard
gives the slots. One shuffle moves the texts, straight to the task of their slots.

Seeds, files and row numbers decide everything, so a task that runs again on another executor
sends the same rows to the same places, whatever its splits. Groups of equal texts are spread
like all other rows; no key decides a place, so none can be hot.

Nulls in any column, empty and very long texts and repeated rows are rows like others: all
count as one. An empty table gives no rows. Columns called ``shard`` and ``slot`` are
replaced; further columns are kept.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from roadpulse.llm.texts import mixed
from roadpulse.session import cut_lineage

#: Rows of a file that are permuted together.
CELL = 1 << 16
#: Groups of cells whose draws the driver makes; fewer where there are very many shards.
GROUPS = 1024
MOST_DRAWS = 1 << 22
#: Bytes of drawn counts up to which all tasks get them; beyond, each row gets those of its cell.
MOST_SENT = 64 << 20


def hypergeometric(random: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` without return are good, out of numbers of any size."""
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    if good + bad < 1_000_000_000:
        return int(random.hypergeometric(good, bad, draws))
    # Ratios of neighbouring probabilities, outward from the mode until nothing is left of them.
    mode = (draws + 1) * (good + 1) // (good + bad + 2)
    total = float(good + bad)
    spread = math.sqrt(max(1.0, draws * (good / total) * (bad / total) * (1 - draws / total)))
    reach = int(40 * spread) + 40
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    ratio = np.log(good - k[:-1]) + np.log(draws - k[:-1]) - np.log(k[1:]) \
        - np.log(bad - draws + k[1:])
    weight = np.append(0.0, np.cumsum(ratio))
    weight = np.cumsum(np.exp(weight - weight.max()))
    return int(k[np.searchsorted(weight, random.random() * weight[-1], side="right")])


def draw(random: np.random.Generator, sizes: np.ndarray, rows: int) -> np.ndarray:
    """Numbers of rows for each shard when ``rows`` places of ``sizes`` are taken at random."""
    out, left = np.zeros(len(sizes), np.int64), int(sizes.sum())
    for k, size in enumerate(sizes.tolist()):
        if not rows:
            break
        left -= size
        out[k] = hypergeometric(random, size, left, rows)
        rows -= int(out[k])
    return out


def matrix(seed: int, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Counts from each source to each shard, with the given sums of rows and of columns."""
    random, left = np.random.default_rng(seed), sizes.astype(np.int64).copy()
    out = np.zeros((len(rows), len(sizes)), np.int64)
    for k, n in enumerate(rows.tolist()):
        out[k] = draw(random, left, n)
        left -= out[k]
    return out


def exact_sizes(rows: int, shards: int) -> np.ndarray:
    return np.full(shards, rows // shards, np.int64) + (np.arange(shards) < rows % shards)


class Permutation:
    """A random permutation of 0 .. n-1: a table if small, else a keyed Feistel network.

    The network works on the least even number of bits that holds n; what it sends beyond n
    goes through it again until it falls below.
    """

    TABLE = 1 << 16
    ROUNDS = 6

    def __init__(self, seed: int, n: int):
        self.n, self.table = n, None
        random = np.random.default_rng(seed)
        if n <= self.TABLE:
            self.table = random.permutation(n)
        self.half = np.uint64(max(1, (int(n - 1).bit_length() + 1) // 2))
        self.keys = random.integers(0, 1 << 63, self.ROUNDS, dtype=np.uint64)

    def _once(self, values: np.ndarray) -> np.ndarray:
        mask = (np.uint64(1) << self.half) - np.uint64(1)
        left, right = values >> self.half, values & mask
        for key in self.keys:
            left, right = right, left ^ (mixed(right ^ key) & mask)
        return left << self.half | right

    def __call__(self, at: np.ndarray) -> np.ndarray:
        if self.table is not None:
            return self.table[at]
        out = self._once(at.astype(np.uint64))
        over = np.flatnonzero(out >= self.n)
        while len(over):
            out[over] = self._once(out[over])
            over = over[out[over] >= self.n]
        return out.astype(np.int64)


@lru_cache(maxsize=64)
def _permutation(seed: tuple[int, ...], n: int) -> Permutation:
    return Permutation(list(seed), n)


def _unused(docs: DataFrame, name: str) -> str:
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def shard(docs: DataFrame, shards: int, seed: int = 11) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``; a computed table is stored once, to fix its rows."""
    return shard_stored(cut_lineage(docs), shards, seed)


def shard_stored(stored: DataFrame, shards: int, seed: int = 11, parts: int | None = None) -> DataFrame:
    """As :func:`shard`, for a plain read of Parquet files, which is not written again.

    Partitions of the result hold neighbouring slots of one shard, in their order.
    """
    stored = stored.drop("shard", "slot")
    spark = stored.sparkSession
    meta = stored.metadataColumn("_metadata")
    file, at, cell = (_unused(stored, c) for c in ("file", "at", "cell"))
    number = meta.getField("row_index")
    placed = stored.withColumns({file: meta.getField("file_path"), at: number % CELL,
                                 cell: F.floor(number / CELL)})
    cells = cut_lineage(placed.groupBy(F.col(file).alias("file"), F.col(cell).alias("cell"))
                        .agg(F.count("*").alias("n"), F.max(at).alias("last")))
    groups = max(1, min(GROUPS, MOST_DRAWS // shards))
    group = F.pmod(F.xxhash64("file", "cell"), F.lit(groups)).cast("int")
    sums = sorted((r["g"], r["n"], r["cells"], r["gaps"]) for r in cells.groupBy(group.alias("g")).agg(
        F.sum("n").alias("n"), F.count("*").alias("cells"),
        F.count_if(F.col("last") + 1 != F.col("n")).alias("gaps")).collect())
    if any(gaps for *_, gaps in sums):
        raise ValueError("not a plain read of stored files; use shard()")
    sizes = exact_sizes(sum(n for _, n, *_ in sums), shards)
    drawn = matrix(seed, np.array([n for _, n, *_ in sums], np.int64), sizes)
    firsts = np.cumsum(drawn, axis=0) - drawn
    shared = spark.sparkContext.broadcast({g: (drawn[k], firsts[k]) for k, (g, *_) in enumerate(sums)})

    def drawn_cells(batches):
        now, random, left, first = None, None, None, None
        for batch in batches:
            out = []
            for g, name, k, n in zip(*(batch.column(c).to_pylist() for c in ("g", "file", "cell", "n"))):
                if g != now:
                    now, random = g, np.random.default_rng([seed, 2, g])
                    left, first = (x.copy() for x in shared.value[g])
                counts = draw(random, left, n)
                out.append((name, k, n, counts.tolist(), first.tolist()))
                left -= counts
                first += counts
            yield pa.RecordBatch.from_pydict(
                dict(zip(("file", "cell", "n", "counts", "firsts"), map(list, zip(*out)))), schema=_CELLS)

    table = cut_lineage(
        cells.select(group.alias("g"), "file", "cell", "n").repartition("g")
        .sortWithinPartitions("g", "file", "cell")
        .mapInArrow(drawn_cells, "file string, cell long, n long, counts array<long>, firsts array<long>"))
    key = F.xxhash64(file, cell)
    if sum(c for _, _, c, _ in sums) * (shards * 16 + 200) <= MOST_SENT:
        held = table.select(F.xxhash64("file", "cell").alias("key"), "n", "counts", "firsts").collect()
        known = spark.sparkContext.broadcast(
            {r["key"]: (r["n"], np.cumsum(r["counts"]), np.array(r["firsts"])) for r in held})
        if len(known.value) != len(held):
            raise ValueError("two cells of one hash; choose another file layout")
        joined, place = placed, _placer(seed, sizes, known)(key, at)
    else:
        names = {c: _unused(stored, c) for c in ("n", "counts", "firsts")}
        joined = placed.join(table.withColumnsRenamed({"file": file, "cell": cell, **names}), [file, cell])
        place = _joined_placer(seed, sizes)(key, at, names["n"], names["counts"], names["firsts"])
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    each = max(1, -(-parts // shards))
    goes = _unused(stored, "goes")
    sent = joined.withColumn(goes, place).select(*stored.columns, f"{goes}.shard", f"{goes}.slot")
    # Slots of a shard are cut into ``each`` equal stretches, one a partition.
    stretch = F.least(F.lit(each - 1), F.floor(
        F.col("slot") * each / _size_of(sizes)).cast("int"))
    return sent.repartitionById(each * shards, F.col("shard") * each + stretch) \
        .sortWithinPartitions("shard", "slot")


_CELLS = pa.schema([("file", pa.string()), ("cell", pa.int64()), ("n", pa.int64()),
                    ("counts", pa.list_(pa.int64())), ("firsts", pa.list_(pa.int64()))])


def _size_of(sizes: np.ndarray) -> Column:
    """The size of the row's shard, at least 1."""
    least, more = int(sizes.min()), int((sizes > sizes.min()).sum())
    return F.greatest(F.lit(1), F.lit(least) + F.when(F.col("shard") < more, 1).otherwise(0))


def _places(seed: int, sizes: np.ndarray, key: np.ndarray, at: np.ndarray, of_cell) -> pd.DataFrame:
    """(shard, slot) of rows: their place in the permuted cell, then in the permuted shard.

    ``of_cell`` gives the size of a cell, the ends of its shards and the first place in each,
    from the cell's key and the number of one of its rows.
    """
    shard, slot = np.zeros(len(key), np.int32), np.zeros(len(key), np.int64)
    for cell in np.unique(key).tolist():
        mine = np.flatnonzero(key == cell)
        n, ends, firsts = of_cell(cell, mine[0])
        place = _permutation((seed, 3, cell & (1 << 64) - 1), int(n))(at[mine])
        to = np.searchsorted(ends, place, side="right")
        shard[mine], slot[mine] = to, place - np.append(0, ends)[to] + firsts[to]
    for to in np.unique(shard).tolist():
        mine = np.flatnonzero(shard == to)
        slot[mine] = _permutation((seed, 1, to), int(sizes[to]))(slot[mine])
    return pd.DataFrame({"shard": shard, "slot": slot})


def _placer(seed: int, sizes: np.ndarray, known: Broadcast):
    @F.pandas_udf("shard int, slot long")
    def place(key: pd.Series, at: pd.Series) -> pd.DataFrame:
        return _places(seed, sizes, key.to_numpy(), at.to_numpy(), lambda cell, _: known.value[cell])

    return place


def _joined_placer(seed: int, sizes: np.ndarray):
    @F.pandas_udf("shard int, slot long")
    def place(key: pd.Series, at: pd.Series, n: pd.Series, counts: pd.Series,
              firsts: pd.Series) -> pd.DataFrame:
        return _places(seed, sizes, key.to_numpy(), at.to_numpy(), lambda _, row: (
            n.iloc[row], np.cumsum(counts.iloc[row]), np.asarray(firsts.iloc[row])))

    return place


def write(sharded: DataFrame, out: str) -> None:
    """One folder a shard, its files in the order of their slots."""
    sharded.write.partitionBy("shard").parquet(out)
