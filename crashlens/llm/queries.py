"""The registered queries: each applies one operator, with production parameters, to its
whole table and derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from crashlens.llm.bpe_codec import encoded
from crashlens.llm.common import fold, table
from crashlens.llm.context_mixing import scores
from crashlens.llm.html_mincut import extract
from crashlens.llm.id_shards import stored_digests
from crashlens.llm.latent_decontamination import leaks
from crashlens.llm.lexical_treap import search
from crashlens.llm.mixing import mix
from crashlens.llm.ngram_join import components_of
from crashlens.llm.quality import quality_flags
from crashlens.llm.spelling_variants import variant_groups
from crashlens.llm.suffix_dedup import removed_bytes
from crashlens.llm.token_counts import LIMIT, token_counts
from crashlens.llm.toxicity import toxicity, train


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_bytes(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_flags(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.concat_ws(",", "failed_rules").alias("failed_rules"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components_of(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)


def op5_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))


def op6_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op7_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op9_id_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", "copies", F.round("position", 9).alias("position"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(table(spark, sf_dir, "documents"))


def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    there_and_back = encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), decode=True)
    return there_and_back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                                 F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                                 F.sha2("text", 256).alias("decoded_sha256"))


def op13_lexical_treap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_suffix_dedup, op2_quality_rules, op3_ngram_join, op4_token_counts, op5_context_mixing, op6_html_mincut, op7_latent_decontamination, op8_toxicity, op9_id_shards, op10_mixing,
                                      op11_spelling_variants, op12_bpe_codec, op13_lexical_treap)}
