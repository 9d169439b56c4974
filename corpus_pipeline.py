"""A training-data pipeline over ``documents``: toxic documents go, one document of each
near-duplicate group stays, documents that hold benchmark items go, the sources are mixed
to their target weights, and the mix is written as token ids and read back.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the
columns of ``docs``. Between stages the documents are written and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlens.llm import id_shards, latent_decontamination, mixing, ngram_join, toxicity
from crashlens.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents with a toxicity of 0.5 or more; the model learns from labelled documents.
    Null and empty texts score as clean; without labels nothing is rejected."""
    return toxicity.accepted(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked documents (5-word shingles, a similarity of
    0.8), that with the smallest id; rows of equal doc_id and text count as one document."""
    kept = ngram_join.representatives(docs, words=5, similarity=80).select(F.col("doc_id").alias("kept_id"), "text_key")
    same = docs["doc_id"].cast("long").eqNullSafe(kept["kept_id"]) & (ngram_join.text_key(docs["text"]) == kept["text_key"])
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold an item of the benchmark. Rows are told apart by id and text,
    so one without an id, or of several with one id, goes by its own text; equal rows go together.
    Null and empty texts hold nothing and stay."""
    rows = docs.select(_row_key(docs).alias("doc_id"), "text")
    found = latent_decontamination.leaks(rows, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("leak_key")).distinct()
    return docs.join(found, _row_key(docs) == found["leak_key"], "left_anti")


def _row_key(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"].cast("long"), F.coalesce(docs["text"], F.lit("")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy that the mix takes, in training order. Texts without words have no size
    and are not taken; a null source is a source of its own."""
    return mixing.training_order(docs)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id shards of the mix; one row per document written, read back through the index.
    A null text is its end id alone; repeated rows are written one after the other."""
    return id_shards.stored_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_ids", write_ids),
]
#: The stages are not all expressible in SQL; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
