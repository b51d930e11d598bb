"""Toxicity: a linear model over character n-grams scaled by naive Bayes log-count ratios.

Features say that a hashed n-gram of the lower-cased bytes occurs in a text at least once,
twice, three or five times. Each is scaled by the log ratio of its smoothed shares among
toxic and other labelled texts; logistic regression with an L2 penalty then learns one weight for each scaled feature.

The model holds at most ``max_features`` features: those seen in eight fitted texts or more whose
class counts lie ``LEAST_SHIFT`` standard deviations or more from chance, the farthest first. N-grams are
of UTF-8 bytes, so a character outside ASCII counts as two to four.

Fitting reads at most ``max_train`` labelled texts, those with the smallest hash of their
id; scoring reads every whole text. Null and empty texts hold no n-gram and get the score
of the bias; null, repeated or contradicting labels: null ones are ignored, several labels
of an id count as separate rows. Without any label the score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadpulse.llm import texts

BUCKETS = 1 << 22
SIZES = (5, 6, 7)
#: A feature is an n-gram together with one of these least numbers of occurrences.
LEVELS = np.array([1, 2, 3, 5])
MAX_TRAIN = 9000
MAX_FEATURES = 4000
#: A feature counts if its class counts lie this many standard deviations from chance.
LEAST_SHIFT = 4.5


@dataclass
class Model:
    """Weights by feature (sorted: bucket times the number of levels, plus level), the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def _grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed n-grams of a chunk with the number of their text, one size after another."""
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    rolling = texts.Rolling(data)
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))
    for size in SIZES:
        starts = texts.starts_of(offsets, size)
        hashes = rolling.every(size)[starts] if len(starts) else np.zeros(0, np.uint64)
        yield (hashes & np.uint64(BUCKETS - 1)).astype(np.int64), owner[starts]


def _levels(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) for every level that the repeats of (text, bucket) keys reach."""
    keys, times = np.unique(keys, return_counts=True)
    own, feature = [], []
    for level, least in enumerate(LEVELS):
        hit = keys[times >= least]
        own.append(hit // BUCKETS)
        feature.append(hit % BUCKETS * len(LEVELS) + level)
    own, feature = np.concatenate(own), np.concatenate(feature)
    order = np.argsort(own, kind="stable")
    return own[order], feature[order]


def _distinct(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _levels(np.concatenate([own * BUCKETS + bucket for bucket, own in _grams(data, offsets)]))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, max_train: int) -> DataFrame:
    """(text, label) of at most ``max_train`` labelled rows, in an order fixed by their ids."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()) \
        .select("doc_id", F.col(label).cast("int").alias("y"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_train)
    return docs.select("doc_id", "text").join(picked, "doc_id").select("text", "y")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_train: int = MAX_TRAIN,
        max_features: int = MAX_FEATURES, penalty: float = 3.0, rounds: int = 120) -> Model:
    sample = training_sample(docs, labels, label, max_train)

    def counted(batches):
        texts.begin("toxicity")
        for batch in texts.chunks(batches):
            data, offsets = texts.text_bytes(texts.column(batch, "text"))
            own, bucket = _distinct(data, offsets)
            y = texts.column(batch, "y").to_numpy(zero_copy_only=False)[own]
            found, inverse = np.unique(bucket, return_inverse=True)
            yield pa.RecordBatch.from_pydict({
                "bucket": found,
                "pos": np.bincount(inverse, y == 1, len(found)).astype(np.int64),
                "neg": np.bincount(inverse, y != 1, len(found)).astype(np.int64)})

    sizes = {r["y"] == 1: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = sizes.get(True, 0), sizes.get(False, 0)
    if not n_pos or not n_neg:
        even = 0.0 if n_pos == n_neg else (4.0 if n_pos else -4.0)
        return Model(np.zeros(0, np.int64), np.zeros(0), even)
    counts = sample.mapInArrow(counted, "bucket long, pos long, neg long") \
        .groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    ratio = F.log((F.col("pos") + 1) / (n_pos + 2)) - F.log((F.col("neg") + 1) / (n_neg + 2))
    rate = (F.col("pos") + F.col("neg")) / F.lit(n_pos + n_neg)
    # How far the counts lie from what the class sizes alone would give.
    expected = rate * n_pos
    shift = F.abs(F.col("pos") - expected) / F.sqrt(expected * (1 - rate) + 0.5)
    top = counts.where(F.col("pos") + F.col("neg") >= 8).select(
        "bucket", ratio.alias("r"), shift.alias("shift")).where(F.col("shift") >= LEAST_SHIFT) \
        .orderBy(F.desc("shift"), "bucket").limit(max_features).toPandas().sort_values("bucket")
    buckets, r = top["bucket"].to_numpy(np.int64), top["r"].to_numpy(float)
    shared = sample.sparkSession.sparkContext.broadcast(buckets)

    def selected(batches):
        texts.begin("toxicity")
        known = shared.value
        for batch in texts.chunks(batches):
            data, offsets = texts.text_bytes(texts.column(batch, "text"))
            own, bucket = _distinct(data, offsets)
            at = np.searchsorted(known, bucket)
            hit = np.flatnonzero(known[np.minimum(at, len(known) - 1)] == bucket) if len(known) \
                else np.zeros(0, np.int64)
            ends = np.searchsorted(own[hit], np.arange(1, len(offsets)))
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, ends), pa.int32()), pa.array(at[hit].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([texts.column(batch, "y"), lists], ["y", "ids"])

    rows = sample.mapInArrow(selected, "y int, ids array<int>").toArrow()
    y = (rows["y"].to_numpy() == 1).astype(float)
    ids = rows["ids"].combine_chunks()
    ends = np.diff(ids.offsets.to_numpy())
    weights, bias = _logistic(np.repeat(np.arange(len(y)), ends), ids.flatten().to_numpy(), y, r,
                              penalty, rounds)
    keep = weights != 0
    return Model(buckets[keep], weights[keep], bias)


def _logistic(row: np.ndarray, feature: np.ndarray, y: np.ndarray, r: np.ndarray,
              penalty: float, rounds: int) -> tuple[np.ndarray, float]:
    """Weights of presence features scaled by ``r``, by accelerated gradient descent."""
    value = r[feature]
    w, bias = np.zeros(len(r)), float(np.log(y.mean() / (1 - y.mean())))
    square = np.bincount(row, value * value, len(y))
    step = 1.0 / (0.25 * max(1.0, float(np.percentile(square, 99))) * len(y) ** 0.5 + penalty)
    held, at, b_at, b_held = w.copy(), w.copy(), bias, bias
    loss_before, momentum = np.inf, 1.0
    for _ in range(rounds):
        z = np.bincount(row, at[feature] * value, len(y)) + b_at
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        loss = float(np.logaddexp(0, np.where(y == 1, -z, z)).sum() + penalty / 2 * (at @ at))
        if loss > loss_before * 1.5:
            step, momentum, at, b_at = step / 4, 1.0, held.copy(), b_held
            loss_before = np.inf
            continue
        gradient = np.bincount(feature, (p - y)[row] * value, len(r)) + penalty * at
        w, bias = at - step * gradient, b_at - float((p - y).sum()) / len(y)
        ahead = (1 + (1 + 4 * momentum * momentum) ** 0.5) / 2
        pull = (momentum - 1) / ahead
        at, b_at = w + pull * (w - held), bias + pull * (bias - b_held)
        held, b_held, momentum, loss_before = w, bias, ahead, loss
    return held * r, b_held


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: toxic likelier) and ``predicted`` (0 or 1).

    Columns of these names in ``docs`` are replaced.
    """
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.bias))

    def scored(batches):
        texts.begin("toxicity")
        features, weights, bias = shared.value
        used = np.zeros(BUCKETS, bool)
        used[features // len(LEVELS)] = True
        for batch in texts.chunks(batches):
            data, offsets = texts.text_bytes(texts.column(batch, "text"))
            z = np.full(len(offsets) - 1, bias)
            pairs = []
            for bucket, own in _grams(data, offsets):
                hit = np.flatnonzero(used[bucket])
                pairs.append(own[hit] * BUCKETS + bucket[hit])
            own, feature = _levels(np.concatenate(pairs))
            if len(features):
                at = np.minimum(np.searchsorted(features, feature), len(features) - 1)
                z += np.bincount(own, np.where(features[at] == feature, weights[at], 0.0), len(z))
            s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                [*batch.schema.names, "score", "predicted"])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(scored, ", ".join([*types, "score double", "predicted int"]))
