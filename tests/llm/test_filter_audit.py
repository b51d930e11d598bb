"""Filter interaction audit against applying all filters in all orders."""

import math
import random
import re
from collections import Counter
from itertools import permutations

import pytest

from roadpulse.llm import filter_audit

DOCS = "doc_id long, text string, lang string, n long, removed string"
LABELS = "doc_id long, quality int, toxic int, part string"


def plain(docs, labels):
    first, good, toxic = {}, set(), set()
    for doc, text, *_ in docs:
        if doc is not None:
            first[text or ""] = min(doc, first.get(text or "", doc))
    for doc, quality, bad, *_ in labels:
        good |= {doc} if quality == 1 and doc is not None else set()
        toxic |= {doc} if bad == 1 and doc is not None else set()
    failing = []
    for doc, text, lang, *_ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else set()
        fails |= {"D"} if re.search("[#$%&*|]", text) else set()
        fails |= {"E"} if doc is not None and text in first and doc > first[text] else set()
        failing.append((lang or "", fails, doc in good, doc in toxic))
    out, sums = [], Counter()
    for part in {lang for lang, *_ in failing}:
        own = [f for f in failing if f[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                sums[part, f] += len(gone)
                out.append((part, order, step, len(left), len(gone), sum(f in d[1] for d in own) - len(gone),
                            sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)))
    return Counter((*r, sums[r[0], r[1][r[2] - 1]]) for r in out)


def check(spark, docs, labels):
    got = filter_audit.audit(spark.createDataFrame(docs, DOCS).repartition(3),
                             spark.createDataFrame(labels, LABELS))
    assert dict(got.dtypes) == {"part": "string", "filter_order": "string", "step": "int"} | dict.fromkeys(
        ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"), "bigint")
    assert Counter(map(tuple, got.collect())) == plain(docs, labels)


def test_awkward_documents(spark):
    rng = random.Random(2)
    long = " ".join(f"w{k}" for k in range(250))
    texts = [None, "", " \n\t ", long, long + " %", "Ab " * 230, " ".join(f"X{k}" for k in range(300)),
             " ".join("ab" * 40 for _ in range(250)), "é" * 90 + " ABC", "É ÀB", "#", long.replace(" ", "\x0b"),
             "x y " * 150, "x y z w " * 50 + "| A", "İ " + long, "word\x1cword " * 210, "long text " * 60_000]
    docs = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice([None, "", "en", "de"]), k, "x")
            for k in range(250)]
    docs += [(5, long, "en", 0, "x")] * 3 + [(None, long, "en", 0, None)] * 2 + [(-3, None, "fr", 0, None)]
    labels = [(rng.choice([None, *range(45)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1]), "p")
              for _ in range(80)]
    check(spark, docs, labels)


def test_hot_text(spark):
    docs = [(k, "same", "en", 0, "x") for k in range(3000)] + [(k, f"one {k}", "de", 0, "x") for k in range(100)]
    check(spark, docs, [(k, k % 2, 1, "p") for k in range(0, 3000, 7)])


def test_empty_tables(spark):
    check(spark, [], [])
    check(spark, [(1, "a", "en", 0, "x")], [])


@pytest.mark.parametrize("size", range(1, 7))
def test_paths_through_the_lattice(size):
    reach, leave = filter_audit.path_counts(size)
    orders = math.factorial(size)
    for state in range(1 << size):
        bits = state.bit_count()
        assert (reach[state], leave[state]) == (math.factorial(bits), math.factorial(size - bits))
    by_filter = Counter()
    for _, f, ways in filter_audit.edges("ABCDEF"[:size]):
        by_filter[f] += ways
    assert all(by_filter[f] == orders for f in range(size))
