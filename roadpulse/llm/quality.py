"""Quality: learned vectors of hashed words and character n-grams, averaged, with softmax.

Features of a text: its words, its character n-grams and its pairs of neighbouring words,
where a word followed by itself gives one shared pair whatever the word. Their vectors are
averaged over the text and a softmax layer gives the two classes; vectors and layer are
learned together by stochastic gradient descent. As the layer is linear in the average,
scoring needs one number a feature: the difference of its two class outputs.

Fitting reads at most ``max_train`` labelled texts (smallest hash of their id); scoring
reads every whole text. Null and empty texts get the score of the bias. Null labels are
ignored; several labels of an id count as separate rows; without labels the score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roadpulse.llm import texts
from roadpulse.llm.toxicity import training_sample

BUCKETS = 1 << 18
SIZES = (3, 4)
DIMENSIONS = 12
MAX_TRAIN = 3000


@dataclass
class Model:
    """Class difference by feature, the bias."""

    outputs: np.ndarray
    bias: float


def _features(data: np.ndarray, offsets: np.ndarray):
    """(bucket, offsets by text) of each kind of feature."""
    rolling = texts.Rolling(data)
    mask = np.uint64(BUCKETS - 1)
    starts, ends, bounds = texts.words(data, offsets)
    word = rolling.of(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    yield (word & mask).astype(np.int64), bounds
    at = texts.starts_of(bounds, 2)
    pair = texts.mixed(word[at] * np.uint64(3) + word[at + 1]) if len(at) else word[:0]
    pair[word[at] == word[at + 1] if len(at) else slice(0)] = np.uint64(1)
    yield (pair & mask).astype(np.int64), np.searchsorted(at, bounds)
    for size in SIZES:
        at = texts.starts_of(offsets, size)
        grams = rolling.every(size)[at] if len(at) else np.zeros(0, np.uint64)
        yield (grams & mask).astype(np.int64), np.searchsorted(at, offsets)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train: int = MAX_TRAIN,
        epochs: int = 8, rate: float = 0.6, seed: int = 7) -> Model:
    sample = training_sample(docs, labels, label, max_train)

    def collected(batches):
        for batch in texts.chunks(batches):
            data, offsets = texts.text_bytes(texts.column(batch, "text"))
            n = len(offsets) - 1
            keys = [np.repeat(np.arange(n), np.diff(bounds)) * BUCKETS + bucket
                    for bucket, bounds in _features(data, offsets)]
            found, times = np.unique(np.concatenate(keys), return_counts=True)
            cut = pa.array(np.searchsorted(found // BUCKETS, np.arange(n + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [texts.column(batch, "y"),
                 pa.ListArray.from_arrays(cut, pa.array((found % BUCKETS).astype(np.int32))),
                 pa.ListArray.from_arrays(cut, pa.array(times.astype(np.int32)))],
                ["y", "ids", "times"])

    rows = sample.mapInArrow(collected, "y int, ids array<int>, times array<int>").toArrow()
    y = (rows["y"].to_numpy() == 1).astype(np.int64)
    outputs = np.zeros(BUCKETS, np.float32)
    if not len(y) or y.min() == y.max():
        return Model(outputs, 0.0 if not len(y) else (4.0 if y[0] else -4.0))
    ids, times = rows["ids"].combine_chunks(), rows["times"].combine_chunks()
    cut, ids, times = ids.offsets.to_numpy(), ids.flatten().to_numpy(), times.flatten().to_numpy()
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    weight = len(y) / (2 * np.bincount(y, minlength=2))
    for epoch in range(epochs):
        speed = rate * (1 - epoch / epochs)
        for k in random.permutation(len(y)):
            f, share = ids[cut[k]:cut[k + 1]], times[cut[k]:cut[k + 1]].astype(np.float32)
            if len(f):
                share /= share.sum()
            mean = share @ vectors[f]
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[k]] -= 1
            p *= speed * weight[y[k]]
            down = layer @ p
            layer -= np.outer(mean, p)
            bias -= 0.1 * p
            vectors[f] -= np.outer(share * min(len(f), 50), down)
    difference = layer[:, 1] - layer[:, 0]
    seen = np.zeros(BUCKETS, bool)
    seen[ids] = True
    outputs = np.where(seen, vectors @ difference, 0).astype(np.float32)
    return Model(outputs, float(bias[1] - bias[0]))


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: good likelier) and ``predicted`` (0 or 1).

    Columns of these names in ``docs`` are replaced.
    """
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast((model.outputs, model.bias))

    def scored(batches):
        outputs, bias = shared.value
        for batch in texts.chunks(batches):
            data, offsets = texts.text_bytes(texts.column(batch, "text"))
            total, number = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
            for bucket, bounds in _features(data, offsets):
                total += texts.sums_by_text(outputs[bucket], bounds)
                number += np.diff(bounds)
            z = total / np.maximum(number, 1) + bias
            s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                [*batch.schema.names, "score", "predicted"])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(scored, ", ".join([*types, "score double", "predicted int"]))
