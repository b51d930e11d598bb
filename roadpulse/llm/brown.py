"""Class-based n-gram scores: Brown classes from exchange clustering, bigrams of classes.

Tokens are words (ASCII white space apart, A-Z in lower case) and one end a text. The model
gives a token, after the token before it (the end before the first),

    P(class | context class) * (count + 1) / (counts + types of the class + 1),

the first factor smoothed with the classes' shares. Every class leaves the mass of one
count to its unknown words, so over all classes, their words and one unknown word each the
probabilities sum to one.

Clustering has two steps. The core, ``ITEMS`` items, are the most frequent words and forms
(endings and kinds of letters, hashed) for all others: their table of neighbours has a fixed
size, and exchange moves one item after another to the class that raises the likelihood of
the class bigrams most, until no move helps. Then every other word of the training texts is
exchanged by itself, on Spark: its counts by the class of the token before it are summed,
at most one number a class, and in each round the words of one half, in turn, move to the
class that raises the likelihood most given the class table of the round before. A round
counts only if the likelihood of all training tokens rose; the first two halves in a row
that gain less than ``LEAST_RISE`` a token, or ``ROUNDS``, end it. The number of classes
grows with the vocabulary, and so does what is exchanged: every word has a class of its own.

As a context, a word outside the core stands for its form; as a predicted word it has its
own class. So a rare word's class is needed where the word is predicted only, and is joined
there. Nothing that grows with the vocabulary is collected: the ``HEAD`` most frequent words
travel to the tasks, with counts and classes, and other words are summed by document and
joined by the word itself. An unknown word has the class of its form.

Null and empty texts are one end. Rows of one id count and are scored apart. Columns of the
result's names are replaced. Without any training token every token has the unknown words'
mass.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from roadpulse.llm import texts
from roadpulse.session import cut_lineage

FREQUENT, FORMS = 1535, 512
#: The item of the end token is the last one.
ITEMS = FREQUENT + FORMS + 1
ALPHA = 8.0
HEAD = 1 << 18
CHUNK = 8 << 20
ROUNDS, LEAST_RISE = 8, 1e-3
END = ""
#: One entry of a word's counts by context class.
ENTRY = np.dtype([("context", "<u2"), ("n", "<i8")])


def class_count(types: int) -> int:
    """Classes for a vocabulary: 25 for 24,000 words, 112 for ten million."""
    return max(4, round(2 * types ** 0.25))


def _lower(array: pa.Array) -> pa.Array:
    # Not pc.ascii_lower, which misplaces the offsets of slices.
    data, offsets = texts.text_bytes(array)
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    return pa.Array.from_buffers(pa.large_string(), len(array), [
        None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.tobytes())])


def words_of(array: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words of lower-cased texts as numbers of distinct words, those, and the cuts between texts."""
    lists = pc.ascii_split_whitespace(_lower(array))
    cuts = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(cuts[0], cuts[-1] - cuts[0]).dictionary_encode()
    index, distinct, cuts = coded.indices.to_numpy().astype(np.int64), coded.dictionary, cuts - cuts[0]
    empty = pc.index(distinct, "").as_py()
    if empty >= 0:
        # White space at the ends of a text, and an empty text, split into empty words.
        real = index != empty
        index, cuts = index[real], np.append(0, np.cumsum(real))[cuts]
    return index, distinct, cuts


def forms(words: pa.Array) -> np.ndarray:
    """A number below FORMS for each word: its last two bytes and what kinds of bytes it has."""
    data, offsets = texts.text_bytes(words)
    starts, ends = offsets[:-1], offsets[1:]
    digit, high = (data >= 48) & (data <= 57), data > 127
    mark = ~(digit | high | ((data | 32) >= 97) & ((data | 32) <= 122))

    def some(kind: np.ndarray, ends: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(kind))
        return (total[ends] > total[starts]).astype(np.uint64)

    padded = np.append(data, np.zeros(2, np.uint8)).astype(np.uint64)
    last = np.where(ends > starts, padded[ends - 1], 0)
    before = np.where(ends > starts + 1, padded[ends - 2], 0)
    key = last | before << np.uint64(8) | some(digit, ends) << np.uint64(16) \
        | some(high, ends) << np.uint64(17) | some(mark, np.maximum(ends - 1, starts)) << np.uint64(18)
    return (texts.mixed(key + np.uint64(1)) % np.uint64(FORMS)).astype(np.int64)


def items_of(words: pa.Array, core: pa.Array) -> np.ndarray:
    """The item of each word: its place in the core, else that of its form."""
    place = pc.fill_null(pc.index_in(words, value_set=core.cast(words.type)), -1)
    place = place.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.where(place >= 0, place, FREQUENT + forms(words))


def neighbours(index: np.ndarray, cuts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence with an end after each text, and the cuts in it."""
    return np.insert(index, cuts[1:], end), cuts + np.arange(len(cuts))


def plog(x):
    return x * np.log(np.maximum(x, 1e-9))


def exchange(counts: np.ndarray, classes: int, rounds: int | None = None,
             end: int | None = None) -> np.ndarray:
    """A class for each item of a square table of neighbour counts.

    Classes start round-robin by frequency. The end item, if given, has a class of its own.
    The gain of a move is the change of sum n log n over class bigrams less that over the
    classes' left and right counts. Rounds go on until no move helps, or ``rounds`` are over.
    """
    n = len(counts)
    size = counts.sum(axis=0) + counts.sum(axis=1)
    order = np.argsort(-size, kind="stable")
    last = classes - 1 if end is not None else classes
    of = np.empty(n, np.int64)
    of[order] = np.arange(n) % last
    if end is not None:
        of[end] = last
    member = np.zeros((n, classes))
    member[np.arange(n), of] = 1
    right, left = counts @ member, counts.T @ member       # by item: to and from classes
    table = member.T @ right

    # Less than this is rounding, on which moves could go on for ever.
    least = 1e-9 + 1e-12 * plog(table.sum())
    for _ in itertools.count() if rounds is None else range(rounds):
        moved = 0
        for w in order:
            if w == end or size[w] == 0:
                continue
            own, self_count = of[w], counts[w, w]
            out_w, in_w = right[w].copy(), left[w].copy()
            out_w[own] -= self_count
            in_w[own] -= self_count
            # Without w.
            table[own] -= out_w
            table[:, own] -= in_w
            table[own, own] -= self_count
            # Wherever w goes, the classes keep what they have to and from it.
            rows, cols = table.sum(axis=1) + in_w, table.sum(axis=0) + out_w
            total_out, total_in = out_w.sum() + self_count, in_w.sum() + self_count
            # Joining class k: row k gains out_w, column k gains in_w, the cell (k, k) all.
            gain = (plog(table + out_w[None]) - plog(table)).sum(axis=1) \
                + (plog(table + in_w[:, None]) - plog(table)).sum(axis=0)
            cell = np.diag(table)
            gain += plog(cell + out_w + in_w + self_count) - plog(cell + out_w) \
                - plog(cell + in_w) + plog(cell)
            gain -= plog(rows + total_out) - plog(rows) + plog(cols + total_in) - plog(cols)
            gain = gain[:last]
            best = int(np.argmax(gain))
            if gain[best] <= gain[own] + least:
                best = own
            if best != own:
                moved += 1
                of[w] = best
                right[:, own] -= counts[:, w]
                right[:, best] += counts[:, w]
                left[:, own] -= counts[w]
                left[:, best] += counts[w]
                out_w, in_w = right[w].copy(), left[w].copy()
                out_w[best] -= self_count
                in_w[best] -= self_count
            table[best] += out_w
            table[:, best] += in_w
            table[best, best] += self_count
        if not moved:
            break
    return of


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all tokens; the end token is the empty word."""
    def counted(batches):
        texts.begin("brown")
        for batch in texts.chunks(batches, limit=CHUNK):
            index, distinct, cuts = words_of(texts.column(batch, "text"))
            n = np.bincount(index, minlength=len(distinct))
            held = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({
                "word": pa.concat_arrays([distinct.take(pa.array(held)).cast(pa.string()),
                                          pa.array([END], pa.string())]),
                "n": np.append(n[held], len(cuts) - 1)})

    return docs.select("text").mapInArrow(counted, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n"))


def core_counts(docs: DataFrame, core: pa.Array) -> np.ndarray:
    """How often one item stands before another, over all texts: ITEMS x ITEMS numbers."""
    def paired(batches):
        texts.begin("brown")
        for batch in texts.chunks(batches, limit=CHUNK):
            index, distinct, cuts = words_of(texts.column(batch, "text"))
            item, _ = neighbours(items_of(distinct, core)[index], cuts, ITEMS - 1)
            before = np.append(ITEMS - 1, item[:-1])
            found, times = np.unique(before * ITEMS + item, return_counts=True)
            yield pa.RecordBatch.from_pydict({"pair": found, "n": times})

    pairs = docs.select("text").mapInArrow(paired, "pair long, n long") \
        .groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(ITEMS * ITEMS)
    table[pairs["pair"].to_numpy()] = pairs["n"].to_numpy()
    return table.reshape(ITEMS, ITEMS)


def _blobs(entries: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.append(0, np.cumsum(sizes)) * ENTRY.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [
        None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(entries.tobytes())]).cast(pa.binary())


def _entries(blobs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = texts.text_bytes(blobs)
    return np.frombuffer(data.tobytes(), ENTRY), offsets // ENTRY.itemsize


def _by_word(key: np.ndarray, n: np.ndarray, classes: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Entries summed by (word, context) keys: the words, their entries and their sums."""
    found, inverse = np.unique(key, return_inverse=True)
    entries = np.empty(len(found), ENTRY)
    entries["context"] = found % classes
    # Sums of doubles are exact below 2 ** 53.
    entries["n"] = np.bincount(inverse, n, len(found)).astype(np.int64)
    word, first = np.unique(found // classes, return_index=True)
    return word, _blobs(entries, np.diff(np.append(first, len(found)))), \
        np.add.reduceat(entries["n"], first) if len(first) else np.zeros(0, np.int64)


def contexts(docs: DataFrame, core: pa.Array, of: np.ndarray, classes: int) -> DataFrame:
    """(word, n, class, counts): words outside the core, with the class of their form and their
    counts by the class before them.

    Rows of a word meet in one task, sorted, and are added up as they come. Such a word is
    rarer than all of the core, and chunks are summed before, so none makes a hot task.
    """
    def counted(batches):
        texts.begin("brown")
        for batch in texts.chunks(batches, limit=CHUNK):
            index, distinct, cuts = words_of(texts.column(batch, "text"))
            item = items_of(distinct, core)
            cls, _ = neighbours(of[item][index], cuts, of[-1])
            word, _ = neighbours(index, cuts, -1)
            before = np.append(of[-1], cls[:-1])
            rare = np.flatnonzero((word >= 0) & (np.append(item, 0)[word] >= FREQUENT))
            found, blobs, _ = _by_word(word[rare] * classes + before[rare], np.ones(len(rare)), classes)
            yield pa.RecordBatch.from_arrays(
                [distinct.take(pa.array(found)).cast(pa.string()), blobs], ["word", "counts"])

    def summed(words: pa.Array, blobs: pa.Array):
        coded = words.dictionary_encode()
        entries, cuts = _entries(blobs)
        key = np.repeat(coded.indices.to_numpy().astype(np.int64), np.diff(cuts)) * classes
        word, blobs, n = _by_word(key + entries["context"], entries["n"], classes)
        return coded.dictionary.take(pa.array(word)), blobs, n

    def merged(batches):
        texts.begin("brown")
        held_word, held = pa.array([], pa.string()), pa.array([], pa.binary())
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                words = pa.concat_arrays([held_word, batch.column(0).cast(pa.string())])
                blobs = pa.concat_arrays([held, batch.column(1).cast(pa.binary())])
            else:
                words, blobs = held_word, held
            if not len(words):
                continue
            words, blobs, n = summed(words, blobs)
            # The last word may go on in the next batch.
            done = len(words) - (batch is not None)
            held_word, held = words.slice(done), blobs.slice(done)
            yield pa.RecordBatch.from_arrays(
                [words.slice(0, done), pa.array(n[:done]),
                 pa.array(of[FREQUENT + forms(words.slice(0, done))].astype(np.int32)),
                 blobs.slice(0, done)], ["word", "n", "class", "counts"])

    return docs.select("text").mapInArrow(counted, "word string, counts binary") \
        .repartition("word").sortWithinPartitions("word") \
        .mapInArrow(merged, "word string, n long, class int, counts binary")


def gains(entries: np.ndarray, cuts: np.ndarray, n: np.ndarray, own: np.ndarray,
          table: np.ndarray) -> np.ndarray:
    """What each class would gain by each word, counted without the word where it is now.

    ``table`` has the tokens by context class and class; its likelihood is the sum of n log n
    over its cells less that over its columns.
    """
    context, count = entries["context"].astype(np.int64), entries["n"].astype(float)
    # Most entries are small counts, so there are few different ones.
    pair, inverse = np.unique(entries["n"] * len(table) + context, return_inverse=True)
    rows = table[pair % len(table)]
    joined = plog(rows + (pair // len(table))[:, None].astype(float)) - plog(rows)
    out = np.add.reduceat(joined[inverse], cuts[:-1], axis=0)
    totals = table.sum(axis=0)
    out -= plog(totals + n[:, None]) - plog(totals)
    here = table[context, np.repeat(own, np.diff(cuts))]
    at = np.arange(len(n))
    out[at, own] = np.add.reduceat(plog(here) - plog(here - count), cuts[:-1]) \
        - plog(totals[own]) + plog(totals[own] - n)
    return out


def exchange_words(words: DataFrame, table: np.ndarray, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``words`` (of :func:`contexts`) with the classes that exchange ends at, and the class table.

    Every round is written, so that a lost executor costs one of them at most. The class of the
    end, the last one, takes no word.
    """
    spark = words.sparkSession
    classes = len(table)

    def likelihood(of: np.ndarray) -> float:
        return float(plog(of).sum() - plog(of.sum(axis=0)).sum())

    def moved_by(table: np.ndarray, half: int):
        shared = spark.sparkContext.broadcast(table)

        def moved(batches):
            texts.begin("brown")
            for batch in batches:
                if not batch.num_rows:
                    continue
                data, offsets = texts.text_bytes(texts.column(batch, "word"))
                turn = (texts.Rolling(data).of(offsets[:-1], offsets[1:]) >> np.uint64(17)) & np.uint64(1)
                turn = np.flatnonzero(turn == half)
                own = texts.column(batch, "class").to_numpy().astype(np.int64).copy()
                if len(turn):
                    entries, cuts = _entries(texts.column(batch, "counts").take(pa.array(turn)))
                    gain = gains(entries, cuts, texts.column(batch, "n").to_numpy()[turn].astype(float),
                                 own[turn], shared.value)[:, :-1]
                    best = gain.argmax(axis=1)
                    at = np.arange(len(turn))
                    better = gain[at, best] > gain[at, own[turn]] + 1e-9
                    own[turn[better]] = best[better]
                yield pa.RecordBatch.from_arrays(
                    [texts.column(batch, "word"), texts.column(batch, "n"),
                     pa.array(own.astype(np.int32)), texts.column(batch, "counts")],
                    ["word", "n", "class", "counts"])
        return moved

    def cells(batches):
        texts.begin("brown")
        total = np.zeros(classes * classes)
        for batch in batches:
            entries, cuts = _entries(texts.column(batch, "counts"))
            cls = np.repeat(texts.column(batch, "class").to_numpy(), np.diff(cuts))
            total += np.bincount(entries["context"].astype(np.int64) * classes + cls,
                                 entries["n"], classes * classes)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": held, "n": total[held].astype(np.int64)})

    def counted(words: DataFrame) -> np.ndarray:
        rows = words.select("class", "counts").mapInArrow(cells, "cell long, n long") \
            .groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        out = np.zeros(classes * classes)
        out[rows["cell"].to_numpy()] = rows["n"].to_numpy()
        return out.reshape(classes, classes)

    reached, tokens, before = likelihood(table), table.sum(), counted(words)
    # Tokens of the core and of ends keep their classes.
    fixed = table - before
    idle = 0
    for turn in range(rounds):
        moved = cut_lineage(words.mapInArrow(moved_by(table, turn % 2), words.schema))
        after = fixed + counted(moved)
        rise = likelihood(after) - reached
        if rise > 0:
            words, table, reached = moved, after, reached + rise
        idle = idle + 1 if rise <= LEAST_RISE * tokens else 0
        if idle == 2:
            break
    return words, table


@dataclass
class Model:
    """What training gives; only ``known`` grows with the vocabulary."""

    #: (word, n, class) of all words but the end.
    known: DataFrame
    core: pa.Array
    #: Classes of the items.
    of: np.ndarray
    #: Tokens by class as a context and class.
    bigrams: np.ndarray
    #: Tokens and types of a class and one more.
    mass: np.ndarray
    tokens: int
    types: int
    end_count: int


def fit(learned: DataFrame, classes: int | None = None, rounds: int = ROUNDS) -> Model:
    """The model of all texts of ``learned``."""
    spark = learned.sparkSession
    vocab = cut_lineage(word_counts(learned).where("n > 0"))
    row = vocab.agg(F.sum("n"), F.count("*")).first()
    tokens, types = row[0] or 0, row[1]
    classes = classes or class_count(types)
    ends = vocab.where(F.col("word") == END).first()
    end_count = ends["n"] if ends else 0
    top = vocab.where(F.col("word") != END).orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    core, core_n = top["word"].combine_chunks().cast(pa.string()), top["n"].to_numpy()
    pairs = core_counts(learned, core)
    of = exchange(pairs, classes, end=ITEMS - 1)
    member = np.zeros((ITEMS, classes))
    member[np.arange(ITEMS), of] = 1
    words, bigrams = exchange_words(cut_lineage(contexts(learned, core, of, classes)),
                                    member.T @ pairs @ member, rounds)
    known = words.select("word", "n", "class").unionByName(spark.createDataFrame(
        [(w, int(n), int(c)) for w, n, c in zip(core.to_pylist(), core_n, of)],
        "word string, n long, class int"))
    mass = np.ones(classes)
    for r in known.groupBy("class").agg(F.count("*").alias("types")).collect():
        mass[r["class"]] += r["types"]
    mass[of[-1]] += end_count > 0
    mass += bigrams.sum(axis=0)
    return Model(known, core, of, bigrams, mass, tokens, types, end_count)


def steps_of(model: Model) -> np.ndarray:
    """log10 of P(class | context class) / mass of the class."""
    share = model.mass / model.mass.sum()
    bigrams = model.bigrams
    step = (bigrams + ALPHA * share[None]) / (bigrams.sum(axis=1, keepdims=True) + ALPHA)
    return np.log10(step) - np.log10(model.mass)[None]


def score(docs: DataFrame, training: Column, classes: int | None = None, head: int = HEAD,
          rounds: int = ROUNDS) -> DataFrame:
    """:func:`scores` of all rows by the model of those for which ``training`` holds."""
    learned = docs.where(F.coalesce(training, F.lit(False))).select("text")
    return scores(docs, fit(learned, classes, rounds), head)


def scores(docs: DataFrame, model: Model, head: int = HEAD) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of each row; scores are log10
    probabilities."""
    spark = docs.sparkSession
    known, core, of, end_count = model.known, model.core, model.of, model.end_count
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    top = known.orderBy(F.desc("n"), "word").limit(head).toArrow()
    head_words, head_counts = top["word"].combine_chunks(), top["n"].to_numpy()
    head_classes = top["class"].to_numpy()
    step = steps_of(model)
    base = math.log10(model.tokens + model.types + 1)
    shared = spark.sparkContext.broadcast((head_words, head_counts, head_classes, core, of, step))

    def scored(batches):
        texts.begin("brown")
        words, counts, own_class, core, of, step = shared.value
        logs = np.append(np.log10(counts + 1), 0.0)
        own_class = np.append(own_class, -1)
        for batch in texts.chunks(batches, limit=CHUNK):
            index, distinct, cuts = words_of(texts.column(batch, "text"))
            place = pc.fill_null(pc.index_in(distinct, value_set=words.cast(distinct.type)), -1) \
                .to_numpy(zero_copy_only=False).astype(np.int64)
            held = place >= 0
            value = np.where(held, logs[place], 0.0)[index]
            as_context = of[items_of(distinct, core)]
            token, bounds = neighbours(index, cuts, -1)
            before, _ = neighbours(as_context[index], cuts, of[-1])
            before = np.append(of[-1], before[:-1])
            n = np.diff(bounds)
            # Words outside the head have no class yet and add nothing here.
            cls = np.append(np.where(held, own_class[place], -1), of[-1])[token]
            steps = texts.sums_by_text(np.where(cls >= 0, step[before, cls], 0.0), bounds)
            rare = np.flatnonzero(cls < 0)
            own = np.searchsorted(bounds, rare, side="right") - 1
            width = len(step)
            key, times = np.unique(
                (own * (len(distinct) + 1) + token[rare]) * width + before[rare], return_counts=True)
            pair = key // width
            row_of, word_of = pair // (len(distinct) + 1), pair % (len(distinct) + 1)
            at = pa.array(np.searchsorted(row_of, np.arange(len(n) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(at, values) for values in (
                distinct.take(pa.array(word_of)).cast(pa.string()),
                pa.array((key % width).astype(np.int32)),
                pa.array(of[FREQUENT + forms(distinct)][word_of].astype(np.int32)),
                pa.array(times.astype(np.int32)))]
            yield pa.RecordBatch.from_arrays(
                [texts.column(batch, "doc_id"), pa.array(n),
                 pa.array(np.diff(np.append(0, np.cumsum(held[index]))[cuts]) + (end_count > 0),
                          pa.int64()),
                 pa.array(texts.sums_by_text(value, cuts) + math.log10(end_count + 1)),
                 pa.array(steps), *lists],
                ["doc_id", "n_tokens", "n_known", "logs", "model", "words", "contexts", "forms", "times"])

    rows = cut_lineage(docs.select("doc_id", "text").mapInArrow(
        scored, "doc_id long, n_tokens long, n_known long, logs double, model double, words array<string>, "
                "contexts array<int>, forms array<int>, times array<int>")
        .withColumn("row", F.monotonically_increasing_id()))
    rare = rows.where(F.size("words") > 0) \
        .select("row", F.explode(F.arrays_zip("words", "contexts", "forms", "times"))) \
        .select("row", F.col("col.words").alias("word"), F.col("col.contexts").alias("context"),
                F.col("col.forms").alias("form"), F.col("col.times").alias("times"))
    tail = known.where(F.col("n") <= int(head_counts[-1]) if len(head_counts) else F.lit(True))
    steps = cut_lineage(spark.createDataFrame(
        [(a, b, float(x)) for a, row in enumerate(step) for b, x in enumerate(row)],
        "context int, class int, step double").coalesce(1))
    found = rare.join(tail, "word", "left") \
        .withColumn("known", F.col("n").isNotNull()) \
        .withColumn("class", F.coalesce("class", "form")).join(steps, ["context", "class"]) \
        .groupBy("row").agg(
            F.sum(F.when(F.col("known"), F.col("times")).otherwise(0)).alias("more"),
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("extra"),
            F.sum(F.col("times") * F.col("step")).alias("steps"))
    logs = F.col("logs") + F.coalesce("extra", F.lit(0.0))
    return rows.drop("words", "contexts", "forms", "times").join(found, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * base).alias("base_score"),
        (logs + F.col("model") + F.coalesce("steps", F.lit(0.0))).alias("score"))
