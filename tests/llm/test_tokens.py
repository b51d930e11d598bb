"""BPE encoder, decoder and token files against the tokenizers library."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cases import awkward, frame
from roadpulse.llm import bpe, token_files
from roadpulse.llm.queries import vocabulary_path
from roadpulse.session import fresh_dir

ODD = ["", "don't we'LL a'sX", "École é ́x", "İstanbul ΣσΣ", "a<|endoftext|>b <|startoftext|>",
       "中文字\U0001f600!!", "x" * 3000, "12345 6,7", "\x00\x01 \x85z", "ab‍cd ﬁ ẞ", "￾ ￿",
       "tab\tfoo\x0bbar\x1cbaz", "<|endoftext", "<|ENDOFTEXT|>"]


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(vocabulary_path())
    made.no_truncation()
    made.no_padding()
    return made


def test_encodes_and_decodes_as_the_library_does(library):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("abcdeinrst'. ,!?éǘΣ 1<>|\n") for _ in range(rng.randint(1, 60)))
                   for _ in range(800)]
    vocab = bpe.vocabulary(vocabulary_path())
    ids, cuts = bpe.encode_texts(pa.array(texts), vocabulary_path())
    out, ends = vocab.decode(ids, cuts)
    for k, text in enumerate(texts):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[cuts[k]:cuts[k + 1]].tolist() == want
        decoded = out.tobytes()[ends[k]:max(ends[k], ends[k + 1] - 1)].decode()
        assert decoded == library.decode(want, skip_special_tokens=False)


def test_encode_keeps_other_columns(spark, library):
    got = bpe.encode(frame(spark), vocabulary_path())
    assert got.columns == ["doc_id", "h", "ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = Counter()
    for doc, text, *_ in awkward():
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded) for r in got.collect()) == want
    assert bpe.encode(frame(spark, []), vocabulary_path()).count() == 0


def test_token_files(spark, library):
    out = fresh_dir(spark, "tokens")
    rows = awkward() + [(20 + k, t, None) for k, t in enumerate(ODD)]
    files = token_files.write(frame(spark, rows), vocabulary_path(), out, parts=4)
    got = token_files.starts(token_files.checksums(files), files).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    assert len(got) == len(order)
    for row, (doc, text, *_) in zip(got, order):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert (row.doc_id, row.start, row.n_tokens) == (doc, start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    # A read by id prunes by Bloom filter and index, and gives back the ids.
    one = token_files.read(spark, out).where("doc_id = 7").collect()
    assert len(one) == 1 and one[0].ids[-1] == 2
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in \
        token_files.read(spark, out).where("doc_id = 7")._jdf.queryExecution().toString()


def test_token_files_of_no_rows(spark):
    files = token_files.write(frame(spark, []), vocabulary_path(), fresh_dir(spark, "tokens"))
    assert token_files.starts(token_files.checksums(files), files).count() == 0
