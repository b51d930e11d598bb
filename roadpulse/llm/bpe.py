"""BPE encoding by backtracking over longest token matches, decoding by an offset table.

An Aho-Corasick automaton finds all tokens of a piece in one pass. The encoder takes the
longest token at each place, as long as it forms a pair with the one before it that no
merge would have broken up; where none fits it steps back. That gives the very tokens of
applying the merges in rank order, in time linear in the piece. The pair test is kept in a
table as it fills.

Texts are cut at ASCII white space, which no token spans, and each distinct word of a chunk
is encoded once. Null texts are empty and give no tokens; ids beyond the vocabulary cannot
be decoded and raise. Columns of the result's names are replaced.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from roadpulse.llm import texts

#: Distinct words a worker remembers before it starts afresh.
REMEMBERED = 150_000
CHUNK = 8 << 20


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """A byte-level BPE with word ends, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model, self.end = held["model"], held["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        steps = held["pre_tokenizer"]["pretokenizers"]
        self.pieces = regex.compile(steps[0]["pattern"]["Regex"]).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") \
            if self.special else None
        self.letters = byte_letters()
        self.ascii = {c: self.letters[ord(c)] for c in map(chr, range(128))}
        ids = model["vocab"]
        size = max([*ids.values(), *self.special.values()]) + 1
        # The end of a word is one more letter; a single letter with it is a base token.
        self.close = "￿"
        spelled = {i: t[:-len(self.end)] + self.close if t.endswith(self.end) and t != self.end
                   else t for t, i in ids.items()}
        self.rank, self.pair, self.split = {}, {}, {i: (i, i) for i in spelled}
        for rank, (left, right) in enumerate(model["merges"]):
            made = ids[left + right]
            self.rank[made] = rank
            self.pair[ids[left], ids[right]] = made
            self.split[made] = (ids[left], ids[right])
        self.length = {i: len(t) for i, t in spelled.items()}
        self.automaton = ahocorasick.Automaton()
        for i, t in spelled.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        known = {t: i for i, t in spelled.items()}
        self.prefix = {}
        for i, t in spelled.items():
            for n in range(len(t) - 1, 0, -1):
                if t[:n] in known:
                    self.prefix[i] = known[t[:n]]
                    break
        self.fits: dict[tuple[int, int], bool] = {}
        shown = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        raw = [shown.get(i, "").encode() for i in range(size)]
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.offsets = np.cumsum([0, *map(len, raw)])
        self.words: dict[str, list[int]] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` side by side."""
        rank, limit = self.rank, len(self.rank) + 1
        while True:
            made = self.pair.get((left, right))
            if made is not None and rank[made] < limit:
                return False
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, self.split[left][1]
            else:
                limit, right = b + 1, self.split[right][0]

    def encode_piece(self, piece: str) -> list[int]:
        """Tokens of one piece given in byte letters with the closing letter."""
        n, length, fits = len(piece), self.length, self.fits
        longest: list[int | None] = [None] * n
        for end, token in self.automaton.iter(piece):
            at = end + 1 - length[token]
            if longest[at] is None or length[token] > length[longest[at]]:
                longest[at] = token
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token = 0, longest[0] if n else None
        while token is not None or at < n:
            last = out[-1] if out else None
            while token is not None:
                end = at + length[token]
                if not dead[end]:
                    if last is None:
                        break
                    ok = fits.get((last, token))
                    if ok is None:
                        if len(fits) > REMEMBERED:
                            fits.clear()
                        ok = fits[last, token] = self.compatible(last, token)
                    if ok:
                        break
                token = self.prefix.get(token)
            if token is None:
                if last is None:
                    raise ValueError("the vocabulary lacks a letter")
                dead[at] = 1
                out.pop()
                at -= length[last]
                token = last
                continue
            out.append(token)
            at = end
            token = longest[at] if at < n else None
        return out

    def _plain(self, text: str) -> list[int]:
        if text.isascii():
            text = text.lower()
        else:
            text = "".join(c.lower() for c in unicodedata.normalize("NFC", text))
        out: list[int] = []
        for piece in self.pieces(text):
            got = self.words.get(piece)
            if got is None:
                if len(self.words) > REMEMBERED:
                    self.words.clear()
                raw = piece if piece.isascii() and piece.isalnum() else \
                    "".join(map(self.letters.__getitem__, piece.encode("utf-8", "surrogatepass")))
                got = self.encode_piece(raw + self.close)
                if len(piece) < 64:
                    self.words[piece] = got
            out += got
        return out

    def encode_word(self, text: str) -> list[int]:
        """Token ids of a text; strings of special tokens give their ids."""
        if self.cut is None or "<" not in text:
            return self._plain(text)
        out: list[int] = []
        for part in self.cut.split(text):
            out += [self.special[part]] if part in self.special else self._plain(part)
        return out

    def decode(self, ids: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of many id lists and their offsets: the tokens joined by one space each."""
        sizes = self.offsets[ids + 1] - self.offsets[ids] + 1
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(sizes, out=ends[1:])
        source = np.arange(ends[-1]) + np.repeat(self.offsets[ids] - ends[:-1], sizes)
        np.minimum(source, len(self.bytes) - 1, out=source)
        out = self.bytes[source]
        out[ends[1:] - 1] = 32
        return out, ends[cuts]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


texts.remembers(vocabulary.cache_clear)


def word_lists(array: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Words of all texts as numbers of distinct words, those, and the cuts between texts."""
    array = pc.fill_null(array.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(array)
    cuts = lists.offsets.to_numpy()
    coded = lists.values.slice(cuts[0], cuts[-1] - cuts[0]).dictionary_encode()
    index, distinct, cuts = coded.indices.to_numpy(), coded.dictionary.to_pylist(), cuts - cuts[0]
    if "" in distinct:
        # White space at the ends of a text, and an empty text, split into empty words.
        real = index != distinct.index("")
        index, cuts = index[real], np.append(0, np.cumsum(real))[cuts]
    return index, distinct, cuts


def gather(lists_flat: np.ndarray, lists_cut: np.ndarray, index: np.ndarray,
           cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists named by ``index`` laid end to end, and the cuts in that."""
    sizes = (lists_cut[1:] - lists_cut[:-1])[index]
    ends = np.zeros(len(index) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    source = np.arange(ends[-1]) + np.repeat(lists_cut[index] - ends[:-1], sizes)
    return lists_flat[source], ends[cuts]


def encode_texts(array: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts laid end to end (unsigned 32 bits), and the cuts between texts."""
    vocab = vocabulary(path)
    index, distinct, cuts = word_lists(array)
    lists = [vocab.encode_word(word) for word in distinct]
    ends = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=ends[1:])
    flat = np.fromiter((i for x in lists for i in x), np.uint32, ends[-1])
    return gather(flat, ends, index, cuts)


def encode(docs: DataFrame, path: str, keep_ids: bool = True) -> DataFrame:
    """``docs`` (without text) with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if
    ``keep_ids``, ``ids`` and ``decoded``; the digests are lower-case hex."""
    new = ["ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256"]
    docs = docs.drop(*new)
    kept = [c for c in docs.columns if c != "text"]

    def coded(batches):
        texts.begin("bpe")
        vocab = vocabulary(path)
        for batch in texts.chunks(batches, limit=CHUNK):
            ids, cuts = encode_texts(texts.column(batch, "text"), path)
            n = np.diff(cuts)
            raw, parts, shas = ids.tobytes(), [], []
            texts_sha = []
            # Decoding goes in stretches of texts, for its index takes eight bytes a byte.
            at = 0
            while at < len(n):
                to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + 500_000)) - 1)
                out, bounds = vocab.decode(ids[cuts[at]:cuts[to]], cuts[at:to + 1] - cuts[at])
                out = out.tobytes()
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    text = out[a:max(a, b - 1)]
                    texts_sha.append(hashlib.sha256(text).hexdigest())
                    if keep_ids:
                        parts.append(text)
                at = to
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                shas.append(hashlib.sha256(raw[4 * a:4 * b]).hexdigest())
            columns = [texts.column(batch, c) for c in kept]
            if keep_ids:
                columns += [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()),
                                                     pa.array(ids.astype(np.int32))),
                            pa.array(parts, pa.binary()).cast(pa.string())]
            columns += [pa.array(n, pa.int64()), pa.array(shas), pa.array(texts_sha)]
            yield pa.RecordBatch.from_arrays(columns, kept + new[0 if keep_ids else 2:])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"]
    if keep_ids:
        types += ["ids array<int>", "decoded string"]
    types += ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
    return docs.mapInArrow(coded, ", ".join(types))
