"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumagrid.llm import (
    decontaminate,
    jaccard_join,
    line_dedup,
    nn_descent,
    packing,
    prefix_trie,
    quality_rules,
    sharding,
    simhash_gray,
    spelling,
    substring_dedup,
    toxicity,
    url_filter,
)

VOCABULARY = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(_table(spark, sf_dir, "pages"))
    return judged.select(
        "page_id",
        "host",
        "path",
        "rule",
        "verdict",
        F.array_join("strict_terms", ",").alias("strict_terms"),
        F.array_join("soft_terms", ",").alias("soft_terms"),
        "soft_weight",
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_rules.train_quality(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.score_quality(docs, model).select(
        "doc_id",
        quality_rules.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality_rules.REJECT_BELOW).cast("int").alias("predicted"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op5_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return packing.digest_pieces(pieces.withColumnRenamed("id", "doc_id"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train_toxicity(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id",
        quality_rules.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.leaks_of_documents(docs, bench).withColumnRenamed("item", "item_id")


def op9_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op13_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_gray.simhash_components(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_quality_rules": op2_quality_rules,
        "op3_line_dedup": op3_line_dedup,
        "op4_nn_descent": op4_nn_descent,
        "op5_bm25_packing": op5_bm25_packing,
        "op6_ngram_jaccard": op6_ngram_jaccard,
        "op7_toxicity": op7_toxicity,
        "op8_decontaminate": op8_decontaminate,
        "op9_rendezvous": op9_rendezvous,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_simhash_gray": op13_simhash_gray,
    }
