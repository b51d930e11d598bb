"""Substring and suffix-array dedup against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from brute import bytes_left, words_left
from cases import awkward, frame
from roadpulse.llm import sketch, substrings, suffixes, texts


@pytest.fixture
def small_batches(spark, large):
    """Batches so small that anchors of more than ``large`` rows come in parts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "10000" if large > 10 else "2")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("large", [200_000, 2])
def test_word_windows(spark, large, small_batches):
    got = substrings.remove(frame(spark), length=12, gram=4, large=large)
    assert got.columns == ["doc_id", "text", "h", "n_words", "n_removed"]
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in got.collect()) \
        == words_left(awkward(), 12)


@pytest.mark.parametrize("large", [200_000, 2])
def test_byte_strings(spark, large, small_batches):
    rows = awkward()
    got = suffixes.remove(frame(spark, rows), length=40, gram=12, large=large).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) \
        == bytes_left(rows, 40)
    assert all(r.text is not None for r in got)


def test_byte_strings_of_random_texts(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("ab") for _ in range(rng.randrange(5, 60))) for _ in range(12)]
    rows = [(k, "".join(rng.choice(base) for _ in range(rng.randrange(9))), None) for k in range(60)]
    got = suffixes.remove(frame(spark, rows), length=20, gram=6).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) \
        == bytes_left(rows, 20)


def test_maximal_repeats_hold_all_occurrences():
    # Suffixes xa.., xa.., xb..; left sides (backwards) "qz", "rz", "qz".
    rights, lefts = ["xxxxa1", "xxxxa2", "xxxxb3"], [b"qz", b"rz", b"qz"]
    prefix = [0, 5, 4]
    found = {(s, b, tuple(sorted(m))) for s, b, m in suffixes.tree_repeats(prefix, lefts, 4)}
    assert rights == sorted(rights)
    assert found == {(5, 0, (0, 1)), (4, 0, (0, 1, 2)), (4, 2, (0, 2))}


def test_empty_table(spark):
    none = frame(spark, [])
    assert substrings.remove(none).count() == 0
    assert suffixes.remove(none).count() == 0


def test_sketch_loses_no_repeat(spark):
    docs = substrings.tagged(frame(spark))

    def hashes(batch):
        data, offsets = texts.text_bytes(texts.column(batch, "text"))
        starts, ends, _ = texts.words(data, offsets)
        return texts.Rolling(data).of(starts, ends)

    bitmaps = sketch.repeated(docs, hashes, 18)
    count = Counter(w for _, t, *_ in awkward() for w in re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert len(count) > 100
    for word, n in count.items():
        raw = np.frombuffer(word.encode(), np.uint8)
        passed = sketch.may_repeat(bitmaps, texts.Rolling(raw).of(np.array([0]), np.array([len(raw)])))
        assert passed[0] or n == 1


def test_anchors_cover_each_window_once_and_follow_content():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 500).astype(np.uint8)
    data[300:400] = data[50:150]
    offsets = np.array([0, 0, 250, 500])
    grams = np.concatenate([texts.Rolling(data).every(5), np.zeros(4, np.uint64)])
    at, first, last = texts.anchors(grams, offsets, 30, 26)
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    assert sorted(starts) == [*range(0, 221), *range(250, 471)]
    owner = {s: a - s for a, f, t in zip(at, first, last) for s in range(f, t + 1)}
    assert all(owner[s] == owner[s + 250] for s in range(50, 121))


def occurrences(raws, string):
    return {(doc, k) for doc, raw in raws.items() for k in range(len(raw) - len(string) + 1)
            if raw[k:k + len(string)] == string}


@pytest.mark.parametrize("large", [300_000, 2])
def test_groups_hold_every_occurrence(spark, large, small_batches):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcd") for _ in range(rng.randrange(10, 90))) for _ in range(9)]
    rows = [(k, "".join(rng.choice(base) for _ in range(rng.randrange(5))), None) for k in range(25)]
    rows += [(100, None, None), (101, "", None), (102, "é" * 40, None)]
    raws = {doc: (t or "").encode() for doc, t, _ in rows}
    found = {}
    for r in suffixes.group_members(frame(spark, rows), length=20, gram=6, large=large).collect():
        members = found.setdefault(bytes(r.group), [])
        members.append((r.doc_id, r.start, raws[r.doc_id][r.start:r.end]))
    assert found
    strings = {}
    for members in found.values():
        [string] = {x for _, _, x in members}
        assert len(string) >= 20 and string not in strings
        places = [(d, k) for d, k, _ in members]
        assert len(places) == len(set(places)) > 1
        assert set(places) == occurrences(raws, string)
        strings[string] = places
    # Every string that repeats is part of a group at each of its places.
    held = {(d, k + j) for s, places in strings.items() for d, k in places for j in range(len(s) - 19)}
    for doc, raw in raws.items():
        for k in range(len(raw) - 19):
            assert ((doc, k) in held) == (len(occurrences(raws, raw[k:k + 20])) > 1)


def test_groups_of_an_empty_table(spark):
    assert suffixes.group_members(frame(spark, [])).count() == 0
