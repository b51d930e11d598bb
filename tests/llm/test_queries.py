"""The registered queries over whole tables, against plain versions and the SQL."""

import hashlib
import math
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from brute import classes
from roadpulse.llm.queries import QUERIES, SQL, vocabulary_path

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.fixture(scope="module")
def docs(db):
    return db.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def rows(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


@pytest.mark.parametrize("name", list(SQL))
def test_sql(spark, db, name):
    got = QUERIES[name](spark, SF_DIR)
    result = db.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(got.columns)
    assert Counter(map(tuple, got.select(columns).collect())) == Counter(result.fetchall())


@pytest.mark.parametrize("name, label", [("op1_toxicity", "toxic"), ("op2_quality", "quality")])
def test_classifiers(spark, db, docs, name, label):
    got = {r.doc_id: r for r in rows(spark, name)}
    assert sorted(got) == [d for d, _ in docs]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1
               for d, r in got.items())
    known = db.execute(f"SELECT doc_id, {label} FROM labels WHERE {label} IS NOT NULL").fetchall()
    held = [(got[d].predicted, y) for d, y in known if d in got and got[d].held_out]
    assert sum(p == y for p, y in held) / len(held) > 0.8


def test_near_copies(spark, docs):
    assert {r.doc_id: r.class_id for r in rows(spark, "op3_order_minhash")} == classes(docs)


def test_tokens(spark, docs):
    library = Tokenizer.from_file(vocabulary_path())
    library.no_truncation()
    library.no_padding()
    files, coded, start = {}, {}, 0
    for doc, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        coded[doc] = (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(
            library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        files[doc] = (start, len(ids) + 1, zlib.crc32(raw + np.array([2], "<u4").tobytes()))
        start += len(ids) + 1
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256)
            for r in rows(spark, "op8_bpe")} == coded
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32)
            for r in rows(spark, "op4_token_files")} == files


def test_class_model(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op5_brown")}
    tokens = {d: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")),
                  ""] for d, t in docs}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    count = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    total, types = sum(count.values()), len(count)
    for doc, ws in tokens.items():
        r = got[doc]
        base = sum(math.log10((count[w] + 1) / (total + types + 1)) for w in ws)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            held[doc], len(ws), sum(count[w] > 0 for w in ws), total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    unseen = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_leaks(spark, db, docs):
    """Documents with most of an item word for word are found, those that share nothing are not."""
    found = {(r.doc_id, r.item_id) for r in rows(spark, "op10_templates")}
    items = {i: re.findall(r"\w+", t.lower()) for i, t in db.execute("SELECT * FROM benchmark").fetchall()}
    for doc, text in docs:
        words = re.findall(r"\w+", (text or "").lower())
        grams = {tuple(words[k:k + 5]) for k in range(len(words) - 4)}
        for item, ws in items.items():
            own = [tuple(ws[k:k + 5]) for k in range(len(ws) - 4)]
            share = sum(g in grams for g in own) / max(1, len(own))
            if share > 0.8:
                assert (doc, item) in found
            if share < 0.1:
                assert (doc, item) not in found
