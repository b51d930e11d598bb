"""The pipeline against plain versions of its stages, each on what the one before it kept."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from brute import bytes_left, classes
from cases import text
from roadpulse.llm import toxicity
from roadpulse.llm.queries import vocabulary_path

ITEM = " ".join(f"{w} {text(77, 3)}" for w in ("why does the quick brown", "engine that leaves station",
                                              "arrive before noon", "when the yellow river"))


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    passage, docs, labels = text(900, 60), [], []
    for k in range(160):
        words = text(2000 + k, 50 + k % 40).split()
        if k % 5 == 0:
            words[5:7] = ["wretched", "vile"]
            words[20] = "dreadful"
        body = " ".join(words)
        if k in (31, 63, 64):
            body += " " + passage
        if k in (41, 92):
            body = ITEM + ". " + body
        docs.append((k, body))
        labels.append((k, 1, int(k % 5 == 0)))
    near = docs[11][1].split()
    near[30] = "other"
    docs += [(200, docs[11][1]), (201, " ".join(near)), (202, docs[12][1]), (203, ""), (204, None),
             (None, text(5000, 40))]
    rows = [(d, t, "en", "s", len(t or "")) for d, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int") \
        .coalesce(1).write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, text(8888, 30))], "item_id long, text string") \
        .coalesce(1).write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages(spark, sf_dir, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_copies", "repeats", "decontamination", "bpe"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, [tuple(r) for r in docs.select("doc_id", "text").collect()]
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    bad = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    assert {k for k in range(160) if k % 5 == 0} <= bad and len(bad) <= 34
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if name == "toxicity":
            kept = [r for r in kept if r[0] not in bad]
        elif name == "near_copies":
            heads = classes([r for r in kept if r[0] is not None])
            kept = [r for r in kept if r[0] is None or heads[r[0]] == r[0]]
            assert {200, 201, 202} & {d for d, _ in kept} == set()
        elif name == "repeats":
            kept = [(d, left.decode("utf-8", "ignore")) for d, *_, left in bytes_left(kept, 100)]
        elif name == "decontamination":
            # What is left of the second copy of the item is no leak any more.
            kept = [r for r in kept if r[0] != 41]
        if name == "bpe":
            break
        assert docs.columns == columns
        assert sorted(map(repr, kept)) == sorted(
            repr((r.doc_id, r.text or "" if number > 1 else r.text)) for r in docs.collect())
        if name == "repeats":
            assert docs.where(F.length("text") != F.col("n_chars")).isEmpty()
    library = Tokenizer.from_file(vocabulary_path())
    want = set()
    for doc, t in kept:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.add((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()))
    assert {(r.doc_id, r.n_tokens, r.ids_sha256) for r in docs.collect()} == want


def test_run_gives_the_last_stage(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert got.count() > 100


def test_no_rows(spark, sf_dir):
    for name, stage in corpus_pipeline.STAGES:
        none = spark.read.parquet(f"{sf_dir}/documents.parquet").where("false")
        assert stage(spark, none, sf_dir).count() == 0
