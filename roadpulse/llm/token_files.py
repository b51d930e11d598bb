"""Token ids in ORC: one row a document, in ascending id order over all files.

Columns: ``doc_id``, ``part`` and ``before`` (the file's number and the ids before the row
in it), ``n_tokens``, ``ids`` (run-length encoded integers). Files carry row indexes, and
Bloom filters on ``doc_id``, so that a read by id skips files, stripes and row groups and
stripes are read in parallel. A document's start in the whole stream is ``before`` plus
the sizes of the files before its own.

Texts go to their place in the order first and are encoded there, by the tokenizers
library; each distinct word is encoded once, as no token spans ASCII white space. Null
texts give the end id alone; null ids come first; rows of one id keep the order of their
texts. Executors write through Spark's committer, so a lost task leaves no part of a file.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from roadpulse.llm import texts
from roadpulse.llm.bpe import byte_letters, gather, word_lists

#: Pieces a worker remembers before it starts afresh.
REMEMBERED = 450_000
#: Bytes of text whose distinct words are encoded together; the more, the fewer words a byte.
CHUNK = 16 << 20
#: The pieces of a lower-case ASCII word, as the vocabulary's own pre-tokenizer cuts them.
_plain = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+").findall
_any = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall


class Encoder:
    """Words to ids: cut here, merged by the library's model, one piece after another.

    The library's whole path takes a word that may hold a special token.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merge = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        self.known: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        spelled = piece if piece.isalpha() and piece.isascii() else "".join(
            map(self.letters.__getitem__, piece.encode("utf-8", "surrogatepass")))
        ids = array("i", [t.id for t in self.merge(spelled)]).tobytes()
        if len(piece) < 64:
            self.known[piece] = ids
        return ids

    def word(self, word: str) -> bytes:
        """The ids of a word without white space, as little-endian 32-bit integers."""
        if word.isascii() and word.isalpha():
            piece = word.lower()
            return self.known.get(piece) or self._piece(piece)
        if "<|" in word:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            return np.array(ids, "<i4").tobytes()
        if word.isascii():
            pieces = _plain(word.lower())
        else:
            word = unicodedata.normalize("NFC", word)
            pieces = _any("".join([c.lower() for c in word]))
        get = self.known.get
        if len(pieces) == 1:
            return get(pieces[0]) or self._piece(pieces[0])
        return b"".join([get(p) or self._piece(p) for p in pieces])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


texts.remembers(encoder.cache_clear)


def write(docs: DataFrame, path: str, out: str, end_id: int = 2,
          parts: int | None = None) -> DataFrame:
    """Write the files under ``out`` and return them as read back."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id") \
        .sortWithinPartitions("doc_id", "text")

    def coded(batches):
        from pyspark import TaskContext
        texts.begin("token_files")
        code, before, part = encoder(path), 0, TaskContext.get().partitionId()
        for batch in texts.chunks(batches, limit=CHUNK):
            index, distinct, cuts = word_lists(texts.column(batch, "text"))
            lists = list(map(code.word, distinct))
            ends = np.zeros(len(lists) + 1, np.int64)
            np.cumsum(list(map(len, lists)), out=ends[1:])
            flat, ends = np.frombuffer(b"".join(lists), "<i4"), ends // 4
            ids, cuts = gather(flat, ends, index, cuts)
            ids = np.insert(ids, cuts[1:], end_id)
            cuts = cuts + np.arange(len(cuts))
            yield pa.RecordBatch.from_arrays(
                [texts.column(batch, "doc_id"), pa.array(np.full(len(cuts) - 1, part, np.int32)),
                 pa.array(before + cuts[:-1]), pa.array(np.diff(cuts)),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids))],
                ["doc_id", "part", "before", "n_tokens", "ids"])
            before += int(cuts[-1])

    schema = "doc_id long, part int, before long, n_tokens long, ids array<int>"
    ordered.mapInArrow(coded, schema).write.option("compression", "zstd") \
        .option("orc.create.index", "true").option("orc.row.index.stride", "1000") \
        .option("orc.stripe.size", str(16 << 20)).option("orc.bloom.filter.columns", "doc_id") \
        .option("orc.bloom.filter.fpp", "0.01").orc(out)
    return read(spark, out)


def read(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(
        "doc_id long, part int, before long, n_tokens long, ids array<int>").orc(out)


def starts(rows: DataFrame, files: DataFrame) -> DataFrame:
    """``rows`` of ``files`` with ``start``, the ids of all documents before a row.

    Sizes come from a scan of the files without their ids, and one short row a file goes
    through the window.
    """
    sizes = files.groupBy("part").agg(F.max(F.col("before") + F.col("n_tokens")).alias("size"))
    base = sizes.select("part", F.coalesce(F.sum("size").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return rows.join(base, "part").withColumn("start", F.col("base") + F.col("before"))


def checksums(files: DataFrame) -> DataFrame:
    """``ids_crc32`` of the ids as little-endian unsigned 32-bit integers, per row."""
    def summed(batches):
        for batch in batches:
            lists = texts.column(batch, "ids")
            cuts = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False),
                                                  "<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [texts.column(batch, c) for c in ("doc_id", "part", "before", "n_tokens")]
                + [pa.array(crc, pa.int64())],
                ["doc_id", "part", "before", "n_tokens", "ids_crc32"])

    return files.mapInArrow(
        summed, "doc_id long, part int, before long, n_tokens long, ids_crc32 long")
