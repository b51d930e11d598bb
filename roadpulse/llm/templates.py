"""Benchmark decontamination by templates: windows with typed placeholders for what varies.

Words become template tokens: numbers, units and names give a placeholder of their type,
all others their letters in lower case without punctuation around them. A name is a word
with a capital inside a sentence; neighbouring names are one slot. Windows with a capital
that opens a sentence are hashed with it as a word and as a name, and with those openings
alone as names that are names elsewhere in the text, as windows of a reading each. Windows of ``WINDOW``
tokens are hashed; items of fewer tokens are one window of
their own size. Windows of more slots than words are hashed with the values of their slots, so that
only literal copies of them match. Windows of documents that a bitmap of the benchmark's hashes lets pass are
joined to the benchmark's by hash.

Matches at one shift between document and item are taken together, and in a run of windows
the same value in the item must stand for the same value in the document; two values of the
item may meet in one. So a question asked again with other numbers, names or units is caught
and a chance mixture is not. Only the windows that disagree are left out: literal ones always
count, and one changed slot leaves the unchanged tokens around it. A document leaks an item
if agreeing windows cover ``least_tokens`` of its tokens, or ``least_share`` of them if it is
shorter.

The bitmap has a fixed size; with a larger benchmark more windows pass to the join and none
is lost. Null and empty texts, and texts of no more than two tokens, match nothing. Rows are
judged by their text: of two rows of one id, null ids too, one may leak and the other not;
a leak is given once for rows equal in id and text. Repeated items count each.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from roadpulse.llm import texts
from roadpulse.llm.bpe import word_lists
from roadpulse.session import cut_lineage

WINDOW = 8
LEAST_TOKENS, LEAST_SHARE = 13, 0.6
SHORTEST = 3
BITS = 22
CHUNK = 8 << 20
LITERAL, NUMBER, UNIT, NAME, NOTHING, MAYBE = range(6)
#: Fixed word lists: units of measure and written numbers.
UNITS = frozenset("""mm cm m km in ft yd mi mg g kg t ml cl l s sec min h hr kb mb gb usd eur gbp
    inch inches foot feet yard yards mile miles metre metres meter meters kilometre kilometres
    kilometer kilometers gram grams kilogram kilograms ton tons tonne tonnes pound pounds ounce
    ounces litre litres liter liters gallon gallons second seconds minute minutes hour hours day
    days week weeks month months year years dollar dollars euro euros cent cents percent degree
    degrees watt watts volt volts joule joules newton newtons""".split())
#: Units that are other words too, in one of the languages; units after a number only.
AMBIGUOUS = frozenset("in m s t g l h mi min sec second".split())
NUMBERS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve
    thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty
    seventy eighty ninety hundred thousand million billion half double triple""".split())
_number = regex.compile(r"[$£€]?[+-]?\d[\d.,:/]*(%|[a-z]{0,3}²?³?)?").fullmatch
_around = regex.compile(r"^[^\w$£€+-]+|[^\w%]+$").sub


@lru_cache(maxsize=100_000)
def canonical(word: str) -> tuple[int, int, bool, bool]:
    """Type, hash of the letters, whether a capital leads, whether a sentence ends after the word."""
    if word.isalpha():
        bare, ends = word, False
    elif word[:-1].isalpha() and word[-1] in ".,!?;:":
        bare, ends = word[:-1], word[-1] not in ",;"
    else:
        ends = word.rstrip("\"')]}»”’")[-1:] in (".", "!", "?", ":", "|")
        bare = _around("", word)
        if not bare:
            return NOTHING, 0, False, ends
    low = bare.lower()
    value = int.from_bytes(blake2b(low.encode("utf-8", "surrogatepass"), digest_size=8).digest(),
                           "little")
    if low in NUMBERS or not low.isalpha() and _number(low):
        return NUMBER, value, False, ends
    if low in UNITS:
        return MAYBE if low in AMBIGUOUS else UNIT, value, False, ends
    capital = bare[0].isupper() and (len(bare) == 1 or not bare.isupper())
    return LITERAL, value, capital, ends


texts.remembers(canonical.cache_clear)


def readings(array: pa.Array):
    """(token values, slot values or 0, cuts between texts, places, own) of all texts by reading.

    A word with a capital that opens a sentence is literal in the first reading, in the second
    a name if it is one inside a sentence of the text, and always a name in the last. Places
    are the numbers the tokens have in the first reading, and one more for the end, so that
    all readings share their positions. Own has counts of words by token: a window that lacks
    them is the same in another reading. The first reading has None.
    """
    index, distinct, cuts = word_lists(array)
    known = [canonical(w) for w in distinct]
    kind = np.array([k[0] for k in known], np.int8)[index] if len(index) else np.zeros(0, np.int8)
    values = np.array([k[1] for k in known], np.uint64)
    value = values[index] if len(index) else np.zeros(0, np.uint64)
    capital = np.array([k[2] for k in known], bool)[index] if len(index) else np.zeros(0, bool)
    ends = np.array([k[3] for k in known], bool)[index] if len(index) else np.zeros(0, bool)
    opening = np.ones(len(index), bool)
    opening[1:] = ends[:-1]
    opening[cuts[:-1][cuts[:-1] < len(index)]] = True
    capital &= kind == LITERAL
    kind = np.where(capital & ~opening, NAME, kind)
    opens = capital & opening
    # Openings that are names elsewhere in their text.
    renamed = np.zeros(len(index), bool)
    if opens.any():
        letters, code = np.unique(values, return_inverse=True)
        text_of = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        at, names = np.flatnonzero(opens), np.flatnonzero(kind == NAME)
        renamed[at] = np.isin(text_of[at] * len(letters) + code[index[at]],
                              text_of[names] * len(letters) + code[index[names]])
    # Marks alone are no tokens.
    real = kind != NOTHING
    cuts = np.append(0, np.cumsum(real))[cuts]
    kind, value, opens, renamed = kind[real], value[real], opens[real], renamed[real]
    first = np.zeros(len(kind), bool)
    first[cuts[:-1][cuts[:-1] < len(kind)]] = True
    # Ambiguous units are units after a number and words like others elsewhere.
    after = np.zeros(len(kind), bool)
    after[1:] = (kind[:-1] == NUMBER) & ~first[1:]
    kind = np.where(kind == MAYBE, np.where(after, UNIT, LITERAL), kind)
    token, slot, own_cuts, heads = _read(kind, value, first, cuts)
    number = np.full(len(kind) + 1, len(heads))
    number[:-1] = np.cumsum(np.bincount(heads, minlength=len(kind))) - 1 if len(kind) else 0
    yield token, slot, own_cuts, np.arange(len(heads) + 1), None
    for as_name in (renamed, opens):
        if not as_name.any():
            continue
        token, slot, own_cuts, heads = _read(np.where(as_name, NAME, kind), value, first, cuts)
        # The mixed reading is of its own where it has openings of both sorts.
        own = [as_name, opens & ~as_name] if as_name is renamed else [as_name]
        own = [np.add.reduceat(words.astype(np.int64), heads) for words in own]
        yield token, slot, own_cuts, number[np.append(heads, len(kind))], own


def _read(kind: np.ndarray, value: np.ndarray, first: np.ndarray, cuts: np.ndarray):
    """(token values, slot values or 0, cuts, numbers of the words that head the tokens)."""
    # Neighbouring names are one slot whose value is that of all of them.
    joined = np.zeros(len(kind), bool)
    joined[1:] = (kind[1:] == NAME) & (kind[:-1] == NAME) & ~first[1:]
    heads = np.flatnonzero(~joined)
    if joined.any():
        place = np.arange(len(kind)) - np.repeat(heads, np.diff(np.append(heads, len(kind))))
        value = value * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1))
        value = np.add.reduceat(value, heads)
    cuts = np.append(0, np.cumsum(~joined))[cuts]
    kind = kind[heads]
    token = np.where(kind == LITERAL, value, kind.astype(np.uint64))
    return token, np.where(kind == LITERAL, np.uint64(0), value | np.uint64(1)), cuts, heads


def _windows(token: np.ndarray, slot: np.ndarray, cuts: np.ndarray, size: int, whole: bool,
             own: list[np.ndarray] | None = None):
    """Starts and hashes of windows of ``size``; ``whole``: only of texts of that size; ``own``:
    counts of words, of each of which a window has to hold one."""
    starts = texts.starts_of(cuts, size)
    if whole and len(starts):
        sizes = np.diff(cuts)
        starts = cuts[:-1][sizes == size]
    for words in own or ():
        held = np.append(0, np.cumsum(words))
        starts = starts[held[starts + size] > held[starts]]
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    filled = np.append(0, np.cumsum(slot != 0))
    hashes = texts.Rolling(token, 5).of(starts, starts + size)
    # Mostly slots: not as a template, but with the values.
    full = np.flatnonzero(2 * (filled[starts + size] - filled[starts]) > size)
    if len(full):
        values = texts.mixed(token) ^ slot
        hashes[full] = texts.Rolling(values, 6).of(starts[full], starts[full] + size)
    return starts, texts.mixed(hashes + np.uint64(size))


def _rows(frame: DataFrame, key: str, sizes: list[int], whole_short: bool, bitmap=None) -> DataFrame:
    """(h, id, tag, at, size, total, slots, places) of the windows of all texts; tag: a hash of the text."""
    shared = frame.sparkSession.sparkContext.broadcast(bitmap) if bitmap is not None else None

    def cut(batches):
        texts.begin("templates")
        for batch in texts.chunks(batches, limit=CHUNK):
            total = None
            for token, slot, cuts, places, words in readings(texts.column(batch, "text")):
                if total is None:
                    total, begins = np.diff(cuts), cuts
                for size in sizes:
                    starts, h = _windows(token, slot, cuts, size, whole_short and size < WINDOW, words)
                    if shared is not None and len(h):
                        cell = (h >> np.uint64(64 - BITS)).astype(np.int64)
                        pass_on = (shared.value[cell >> 3] >> (cell & 7).astype(np.uint8) & 1) == 1
                        starts, h = starts[pass_on], h[pass_on]
                    if not len(h):
                        continue
                    own = np.searchsorted(cuts, starts, side="right") - 1
                    slots = slot[(starts[:, None] + np.arange(size))].view(np.int64)
                    where = places[starts[:, None] + np.arange(size + 1)] - begins[own][:, None]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), texts.column(batch, key).take(pa.array(own)),
                         texts.column(batch, "tag").take(pa.array(own)), pa.array(where[:, 0]), pa.array(np.full(len(h), size, np.int32)),
                         pa.array(total[own]), _lists(slots), _lists(where)],
                        ["h", key, "tag", "at", "size", "total", "slots", "places"])

    source = frame.select(F.col(key).cast("long").alias(key), F.xxhash64("text").alias("tag"),
                          F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(
        cut, f"h long, {key} long, tag long, at long, size int, total long, slots array<long>, "
             "places array<long>")


def _lists(table: np.ndarray) -> pa.Array:
    rows, width = table.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()),
                                    pa.array(table.reshape(-1)))


def _agreeing(windows: list[dict]) -> tuple[list[int], int]:
    """(tokens of the item, slot values replaced) of the windows that agree in their run.

    In a run of overlapping windows each value of the item stands for the value it meets at
    most places, itself in a tie. A window that says otherwise is left out, unless it is
    literal; with one slot changed its unchanged tokens still count.
    """
    runs, end = [], -1
    for w in sorted(windows, key=lambda w: w["places"][0]):
        if w["places"][0] >= end:
            runs.append([])
        runs[-1].append(w)
        end = max(end, w["places"][-1])
    tokens, changed = set(), set()
    for run in runs:
        places = {}
        for w in run:
            for at, *pair in zip(w["places"], w["item_slots"], w["slots"]):
                if pair[0]:
                    places.setdefault(tuple(pair), set()).add(at)
        stands = {}
        for (ours, theirs), at in places.items():
            rank = (len(at), ours == theirs, theirs)
            stands[ours] = max(stands.get(ours, rank), rank)
        for w in run:
            pairs = list(zip(w["item_slots"], w["slots"]))
            differ = {p for p in pairs if p[0] != p[1]}
            agrees = all(not p[0] or stands[p[0]][2] == p[1] for p in pairs)
            if not agrees and sum(p in differ for p in pairs) > 1:
                continue
            for p, at, end in zip(pairs, w["places"], w["places"][1:]):
                if agrees or p not in differ:
                    tokens.update(range(at, end))
            changed |= differ
    return sorted(tokens), len(changed)


def _judged(batches):
    for batch in batches:
        windows = texts.column(batch, "windows")
        rows = np.flatnonzero(windows.is_valid().to_numpy(zero_copy_only=False))
        kept = batch.select(["doc_id", "tag", "item_id", "item_total", "changed", "tokens"])
        if len(rows):
            tokens, changed = kept.column("tokens").to_pylist(), kept.column("changed").to_pylist()
            for row, held in zip(rows, windows.take(pa.array(rows)).to_pylist()):
                tokens[row], changed[row] = _agreeing(held)
            kept = kept.set_column(4, "changed", pa.array(changed, pa.int64())) \
                .set_column(5, "tokens", pa.array(tokens, pa.list_(pa.int64())))
        yield kept


def leaks(docs: DataFrame, benchmark: DataFrame, least_tokens: int = LEAST_TOKENS,
          least_share: float = LEAST_SHARE) -> DataFrame:
    """(doc_id, tag, item_id, n_tokens, n_changed): the tokens of the item found in the document
    and how many of its slot values were replaced; ``tag`` is xxhash64 of its text."""
    sizes = list(range(SHORTEST, WINDOW + 1))
    items = cut_lineage(_rows(benchmark, "item_id", sizes, True))
    used = items.groupBy("size").count().collect()
    sizes = sorted(r["size"] for r in used)
    cells = items.select(F.shiftrightunsigned("h", 64 - BITS).alias("cell")).distinct().toArrow()
    bitmap = np.zeros(1 << BITS, bool)
    bitmap[cells["cell"].to_numpy()] = True
    found = _rows(docs, "doc_id", sizes, False, np.packbits(bitmap, bitorder="little"))
    theirs = items.select("h", "size", "item_id", F.col("at").alias("item_at"),
                          F.col("total").alias("item_total"), F.col("slots").alias("item_slots"),
                          "places")
    matched = found.drop("total", "places").join(theirs, ["h", "size"]).withColumn(
        "pairs", F.filter(F.arrays_zip("item_slots", "slots"), lambda p: p["item_slots"] != 0))
    shifted = matched.groupBy("doc_id", "tag", "item_id", "item_total", (F.col("at") - F.col("item_at"))
                              .alias("shift")).agg(
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
        F.collect_set(F.struct("places", "item_slots", "slots")).alias("windows"))
    clash = F.size("pairs") != F.size(F.array_distinct(F.transform("pairs", lambda p: p["item_slots"])))
    changed = F.size(F.filter("pairs", lambda p: p["item_slots"] != p["slots"]))
    tokens = F.array_distinct(F.flatten(F.transform(
        "windows", lambda w: F.sequence(w["places"][0], F.element_at(w["places"], -1) - 1))))
    judged = shifted.select(
        "doc_id", "tag", "item_id", "item_total", changed.cast("long").alias("changed"), tokens.alias("tokens"),
        F.when(clash, F.col("windows")).alias("windows"))
    judged = judged.mapInArrow(
        _judged, "doc_id long, tag long, item_id long, item_total long, changed long, tokens array<long>")
    return judged.groupBy("doc_id", "tag", "item_id", "item_total").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("tokens")))).cast("long").alias("n_tokens"),
        F.sum("changed").alias("n_changed")) \
        .where((F.col("n_tokens") >= least_tokens)
               | (F.col("n_tokens") >= least_share * F.col("item_total"))) \
        .select("doc_id", "tag", "item_id", "n_tokens", "n_changed")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that leak an item."""
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(bad["__id"]) & (F.xxhash64(docs["text"]) == bad["__tag"])
    return docs.join(bad, same, "left_anti")
