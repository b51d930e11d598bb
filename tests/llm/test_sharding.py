"""Sharding: exact sizes, gapless slots, a uniform shuffle, and the law of the counts."""

import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from cases import SCHEMA, awkward, frame
from roadpulse.llm import sharding
from roadpulse.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def placed(df):
    return sorted((r.shard, r.slot) for r in df.collect())


def expected(rows, shards):
    sizes = [rows // shards + (k < rows % shards) for k in range(shards)]
    return [(k, i) for k, n in enumerate(sizes) for i in range(n)]


@pytest.mark.parametrize("shards", [1, 3, 7, 40])
def test_sizes_are_exact_and_slots_have_no_gap(spark, shards):
    rows = awkward()
    out = sharding.shard(frame(spark).withColumn("slot", sharding.F.lit("old")), shards)
    assert placed(out) == expected(len(rows), shards)
    assert Counter((r.doc_id, r.text, r.h) for r in out.collect()) == Counter(rows)
    assert sorted(out.columns) == ["doc_id", "h", "shard", "slot", "text"]


def test_empty_table(spark):
    assert sharding.shard(spark.createDataFrame([], SCHEMA), 5).collect() == []


def test_hot_and_long_rows(spark):
    rows = [(1, "same", "x")] * 300 + [(k, "y" * 40, "x") for k in range(100)] + [(None, "z" * 2_000_000, None)]
    out = sharding.shard(frame(spark, rows), 8)
    assert placed(out) == expected(len(rows), 8)
    per_shard = Counter(r.shard for r in out.collect() if r.text == "same")
    assert max(per_shard.values()) < 50


@pytest.mark.parametrize("columns", ["file string, at int, cell int, goes int, n int, counts int"])
def test_clashing_names(spark, columns):
    rows = [tuple(f"{k}" if c == 0 else k for c in range(6)) for k in range(50)]
    out = sharding.shard(spark.createDataFrame(rows, columns), 4)
    assert placed(out) == expected(50, 4)
    assert Counter(tuple(r)[:6] for r in out.collect()) == Counter(rows)


def test_splits_do_not_matter(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20_000).repartition(3).write.parquet(path)
    results = []
    for size in ("128m", "16k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        results.append({r.id: (r.shard, r.slot) for r in sharding.shard_stored(
            spark.read.parquet(path), 6).collect()})
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert results[0] == results[1]
    joined = sharding.MOST_SENT
    sharding.MOST_SENT = 0
    try:
        other = {r.id: (r.shard, r.slot) for r in sharding.shard_stored(spark.read.parquet(path), 6).collect()}
    finally:
        sharding.MOST_SENT = joined
    assert other == results[0]


def test_filtered_reads_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).write.parquet(path)
    with pytest.raises(ValueError):
        sharding.shard_stored(spark.read.parquet(path).where("id % 2 = 0"), 4)


def test_files_of_shards_hold_their_slots_in_order(spark, tmp_path):
    out = str(tmp_path / "out")
    sharding.write(sharding.shard(spark.range(500), 4), out)
    assert placed(spark.read.parquet(out)) == expected(500, 4)
    for file in Path(out).glob("shard=*/*.parquet"):
        slots = [r.slot for r in spark.read.parquet(str(file)).collect()]
        assert slots == sorted(slots)


def test_every_place_is_equally_likely(spark, tmp_path):
    """Each of 12 rows, in three files, falls on each place about equally often."""
    path, rounds = str(tmp_path / "t"), 30
    spark.range(12).repartition(3, "id").write.parquet(path)
    table, seen = spark.read.parquet(path), np.zeros((12, 12))
    for seed in range(rounds):
        for r in sharding.shard_stored(table, 3, seed, parts=3).collect():
            seen[r.id, r.shard * 4 + r.slot] += 1
    share = rounds / 12
    assert ((seen - share) ** 2 / share).sum() < 121 + 5 * (2 * 121) ** 0.5


def test_counts_follow_the_hypergeometric_law():
    rows, sizes = np.array([3, 5, 2]), np.array([4, 4, 2])
    drawn, plain = Counter(), Counter()
    rng = random.Random(5)
    for seed in range(20_000):
        drawn[tuple(map(tuple, sharding.matrix(seed, rows, sizes)))] += 1
        places = [0] * 4 + [1] * 4 + [2] * 2
        rng.shuffle(places)
        cut = places[:3], places[3:8], places[8:]
        plain[tuple(tuple(c.count(k) for k in range(3)) for c in cut)] += 1
    for key, n in plain.items():
        assert abs(drawn[key] - n) < 6 * (2 * n) ** 0.5 + 6


def test_large_numbers_follow_the_same_law():
    rng = np.random.default_rng(3)
    got = np.array([sharding.hypergeometric(rng, 600_000_000, 5_400_000_000, 40_000) for _ in range(4000)])
    assert abs(got.mean() - 4000) < 5 * 60 / 4000 ** 0.5
    assert 55 < got.std() < 65
    total = np.array([30_000_000_000, 20_000_000_000, 3])
    assert sharding.matrix(1, total, sharding.exact_sizes(int(total.sum()), 4)).sum(axis=1).tolist() == total.tolist()


@pytest.mark.parametrize("n", [1, 2, 3, 1000, 65_537, 100_003, 1 << 18])
def test_permutations(n):
    for seed in range(3):
        assert (np.sort(sharding.Permutation(seed, n)(np.arange(n))) == np.arange(n)).all()


def test_large_permutations_mix():
    n = 100_000
    to = sharding.Permutation(4, n)(np.arange(n))
    counts = np.histogram2d(np.arange(n), to, bins=20, range=[[0, n], [0, n]])[0]
    assert ((counts - 250) ** 2 / 250).sum() < 400 + 6 * (2 * 400) ** 0.5


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = QUERIES["op11_sharding"](spark, SF_DIR)
    rows = got.collect()
    assert dict(got.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string",
                                "shard": "int", "slot": "bigint", "grown_shard": "int"}
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (d.doc_id, len((d.text or "").encode()) + 16, zlib.crc32((d.text or "").encode())) for d in docs)
    assert placed(got) == expected(len(docs), 40)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
