"""The corpus pipeline: each stage works on all documents that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadpulse.llm import bpe, order_minhash, suffixes, templates, toxicity
from roadpulse.llm.queries import table, vocabulary_path
from roadpulse.session import fresh_dir

#: Scores are learned from labels, which SQL cannot express.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0").select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the least id."""
    return order_minhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings that stand in an earlier document go; every document stays, maybe shorter."""
    return suffixes.remove(docs).withColumn("n_chars", F.length("text").cast("long")) \
        .select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a question of the benchmark go."""
    return templates.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text they decode to."""
    return bpe.encode(docs.select("doc_id", "text"), vocabulary_path(), keep_ids=False) \
        .select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies),
          ("repeats", cut_repeats), ("decontamination", drop_leaks), ("bpe", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
