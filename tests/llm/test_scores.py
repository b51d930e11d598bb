"""Classifiers on held-out rows, the class model against its definition."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cases import awkward, frame, text
from roadpulse.llm import brown, quality, toxicity


def labelled(spark, n=400):
    docs, labels = [], []
    for k in range(n):
        words = text(1000 + k, 40 + k % 60).split()
        toxic, good = k % 4 == 0, k % 3 > 0
        if toxic:
            words[k % 30] = ("wretched", "vile", "dreadful")[k % 3]
            words[k % 17 + 3] = ("vile", "dreadful", "wretched")[k % 3]
        if not good:
            words = [w + "%%%" for w in words] if k % 2 else [w for w in words[:9] for _ in range(6)]
        docs.append((k, " ".join(words), None))
        labels.append((k, int(good), int(toxic)))
    return frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("operator, label", [(toxicity, "toxic"), (quality, "quality")])
def test_held_out_accuracy(spark, operator, label):
    docs, labels = labelled(spark)
    held = F.col("doc_id") % 3 == 1
    model = operator.fit(docs, labels.where(~held), label)
    scored = operator.score(docs, model).join(labels, "doc_id").where(held).collect()
    right = sum(r.predicted == r[label] for r in scored)
    assert right / len(scored) > 0.95
    assert all(0 <= r.score <= 1 for r in scored)


@pytest.mark.parametrize("operator, label", [(toxicity, "toxic"), (quality, "quality")])
def test_awkward_rows_and_labels(spark, operator, label):
    docs, labels = labelled(spark, 60)
    labels = labels.unionByName(spark.createDataFrame(
        [(None, 1, 1), (3, None, None), (4, 0, 1), (4, 1, 0)], labels.schema))
    rows = [(d, t, "x") for d, t, _ in awkward()]
    some = frame(spark, rows).withColumn("score", F.lit("clash"))
    got = operator.score(some, operator.fit(docs, labels, label))
    assert got.columns == ["doc_id", "text", "h", "score", "predicted"]
    got = got.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if not r.text}
    assert len(empty) == 1
    # No labels, no documents.
    none = operator.fit(docs, labels.where("false"), label)
    assert {r.score for r in operator.score(some, none).collect()} == {0.5}
    assert operator.score(frame(spark, []), none).count() == 0
    assert operator.score(some, operator.fit(frame(spark, []), labels, label)).count() == len(rows)


def tokens(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), ""]


def test_class_model(spark):
    rows = awkward() + [(100 + k, text(50 + k, 60).upper() if k % 2 else text(50 + k, 60), None)
                        for k in range(60)]
    train = F.col("doc_id") % 5 != 2
    got = brown.score(frame(spark, rows), train, classes=8, head=20).collect()
    trained = [t for d, t, *_ in rows if d is not None and math.fmod(d, 5) != 2]
    count = Counter(w for t in trained for w in tokens(t))
    total, types = sum(count.values()), len(count)
    want = Counter()
    for doc, t, *_ in rows:
        words = tokens(t)
        want[doc, len(words), sum(count[w] > 0 for w in words), round(sum(
            math.log10((count[w] + 1) / (total + types + 1)) for w in words), 6)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {total}
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    # A head that holds all words gives the same scores.
    whole = brown.score(frame(spark, rows), train, classes=8).collect()
    assert Counter((r.doc_id, round(r.score, 6)) for r in got) \
        == Counter((r.doc_id, round(r.score, 6)) for r in whole)


def test_lower_case_of_slices():
    whole = pa.array(["ABC é Ü", None, "Def " * 40, "", "xYz"])
    for k in range(5):
        got = brown._lower(whole.slice(k))
        got.validate(full=True)
        assert got.to_pylist() == ["abc é Ü", "", "def " * 40, "", "xyz"][k:]


def test_class_model_without_training_or_rows(spark):
    got = brown.score(frame(spark), F.lit(False), classes=4).collect()
    assert len(got) == len(awkward()) and {(r.train_tokens, r.n_known) for r in got} == {(0, 0)}
    assert brown.score(frame(spark, []), F.lit(True), classes=4).count() == 0


def likelihood(counts, of, classes):
    member = np.eye(classes)[of]
    table = member.T @ counts @ member
    return sum((x[x > 0] * np.log(x[x > 0])).sum() * sign for x, sign in
               ((table, 1), (table.sum(axis=0), -1), (table.sum(axis=1), -1)))


def test_exchange_ends_where_no_move_helps():
    rng = np.random.default_rng(6)
    counts = rng.integers(0, 4, (14, 14)).astype(float)
    counts[:6, 6:12] += rng.integers(5, 20, (6, 6))
    counts[6:12, :6] += rng.integers(5, 20, (6, 6))
    of = brown.exchange(counts, classes=4, rounds=50, end=13)
    assert of[13] == 3 and (of[:13] < 3).all()
    reached = likelihood(counts, of, 4)
    for w in range(13):
        for k in range(3):
            moved = of.copy()
            moved[w] = k
            assert likelihood(counts, moved, 4) <= reached + 1e-6


def test_exchange_leaves_no_move_of_many_items():
    counts = np.random.default_rng(2).poisson(0.3, (210, 210)).astype(float)
    of = brown.exchange(counts, classes=4)
    reached = likelihood(counts, of, 4)
    for w in range(210):
        for k in range(4):
            moved = of.copy()
            moved[w] = k
            assert likelihood(counts, moved, 4) <= reached + 1e-6


def test_probabilities_sum_to_one(spark):
    """All continuations of a text by one token, known words and one unknown for each class."""
    rows = [(k, text(70 + k, 30), None) for k in range(20)]
    known = sorted({w for _, t, _ in rows for w in tokens(t)[:-1]})
    model = brown.score(frame(spark, rows + [(1000 + k, w, None) for k, w in enumerate(known)]
                              + [(5000, "", None)]), F.col("doc_id") < 1000, classes=4)
    by = {r.doc_id: r.score for r in model.collect()}
    # P(word) P(end | word) over all words and P(end) is at most one; unknown words have the rest.
    assert 0 < sum(10 ** s for d, s in by.items() if d >= 1000) <= 1


def bigram_likelihood(table):
    return sum((x[x > 0] * np.log(x[x > 0])).sum() * sign
               for x, sign in ((table, 1), (table.sum(axis=0), -1)))


def test_gains_are_differences_of_the_likelihood():
    rng = np.random.default_rng(8)
    hists = rng.integers(0, 4, (12, 5)) + np.eye(12, 5, dtype=int)
    hists[11] = [0, 0, 900, 0, 0]
    own = rng.integers(0, 5, 12)
    table = np.zeros((5, 5))
    np.add.at(table.T, own, hists)
    word, context = np.nonzero(hists)
    entries = np.empty(len(word), brown.ENTRY)
    entries["context"], entries["n"] = context, hists[word, context]
    cuts = np.searchsorted(word, np.arange(13))
    got = brown.gains(entries, cuts, hists.sum(axis=1).astype(float), own, table)
    for w in range(12):
        without = table.copy()
        without[:, own[w]] -= hists[w]
        for k in range(5):
            moved = without.copy()
            moved[:, k] += hists[w]
            assert got[w, k] == pytest.approx(
                bigram_likelihood(moved) - bigram_likelihood(without), abs=1e-6)


def class_docs():
    """More words than the core has: six thousand rare ones, each after words of one kind."""
    rows = [(k, text(50 + k, 60).upper() if k % 2 else text(50 + k, 60), None) for k in range(40)]
    rows += [(200 + k, " ".join(f"{('the', 'river')[j % 2]} {'qx'[j % 2]}{j}z" for j in range(k * 50, k * 50 + 50))
              + " end.", None) for k in range(120)]
    return rows + [(900, None, None), (901, "", None), (None, "The unseen qq1 qq1", None),
                   (902, "never é seen the q7z river x9z q2z", None)]


@pytest.mark.parametrize("head", [30, brown.HEAD])
def test_class_scores_against_a_plain_model(spark, head):
    rows = class_docs()
    docs = frame(spark, rows)
    trained = [t for d, t, _ in rows if d is not None and d < 900]
    model = brown.fit(docs.where("doc_id < 900"), classes=6)
    cls = {r["word"]: r["class"] for r in model.known.collect()}
    count = Counter(w for t in trained for w in tokens(t))
    assert {r["word"]: r["n"] for r in model.known.collect()} == {w: n for w, n in count.items() if w}
    core = dict(zip(model.core.to_pylist(), model.of.tolist()))
    assert len(core) == brown.FREQUENT and all(cls[w] == c for w, c in core.items())
    end = model.of[-1]
    assert end not in cls.values()

    def form(w):
        return int(model.of[brown.FREQUENT + brown.forms(pa.array([w]))[0]])

    def context(w):
        return end if w == "" else core.get(w, None) if w in core else form(w)

    def own(w):
        return end if w == "" else cls.get(w, None) if w in cls else form(w)

    table = np.zeros((6, 6))
    for t in trained:
        words = tokens(t)
        for a, b in zip(["", *words], words):
            table[context(a), own(b)] += 1
    assert (table == model.bigrams).all()
    types = Counter(own(w) for w in count)
    mass = [table[:, c].sum() + types[c] + 1 for c in range(6)]
    assert mass == model.mass.tolist()
    want = Counter()
    for doc, t, _ in rows:
        words, total = tokens(t), 0.0
        for a, b in zip(["", *words], words):
            a, c = context(a), own(b)
            p = (table[a, c] + brown.ALPHA * mass[c] / sum(mass)) / (table[a].sum() + brown.ALPHA)
            total += math.log10(p * (count[b] + 1) / mass[c])
        want[doc, len(words), round(total, 6)] += 1
    got = brown.scores(docs, model, head).collect()
    assert Counter((r.doc_id, r.n_tokens, round(r.score, 6)) for r in got) == want


def test_every_word_is_exchanged_and_the_likelihood_rises(spark):
    learned = frame(spark, class_docs()).where("doc_id < 900")
    still, moved = brown.fit(learned, classes=6, rounds=0), brown.fit(learned, classes=6)
    assert bigram_likelihood(moved.bigrams) > bigram_likelihood(still.bigrams)
    # Each word stood after "the" or after "river" only, whatever its form.
    cls = {r["word"]: r["class"] for r in moved.known.collect()}
    for kind in (0, 1):
        mine = {f"{'qx'[kind]}{j}z" for j in range(kind, 6000, 2)} - set(moved.core.to_pylist())
        assert len(mine) > 1500
        assert Counter(cls[w] for w in mine).most_common(1)[0][1] > 0.95 * len(mine)


def test_classes_grow_with_the_vocabulary():
    assert [brown.class_count(n) for n in (0, 24_000, 10_000_000)] == [4, 25, 112]
