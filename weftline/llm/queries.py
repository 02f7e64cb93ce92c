"""Queries of the operators over the whole tables of a folder, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import ball_tree, decontaminate, language, minhash, oracles, packing, prefix_trie, quality, scoring, sharding, simhash, suffix_dedup, token_files, window_dedup


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    blocks, index = token_files.token_files(docs, "word_bpe_49k.json", end_id=1)
    return token_files.read(spark, blocks, index, docs)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scores(table(spark, sf_dir, "documents"), folds=7, fold=2)


def op6_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.window_dedup(table(spark, sf_dir, "documents"), width=50)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", capacity=2048, end_id=0)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"), width=50)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), n_shards=40)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_token_files, op2_minhash, op3_suffix_dedup, op4_language_id, op5_lm_scoring, op6_window_dedup, op7_best_fit_packing, op8_decontamination, op9_sharding, op10_quality_rules, op11_hard_negatives, op12_simhash, op13_prefix_trie)}
ORACLES: dict[str, str] = oracles.ORACLES
