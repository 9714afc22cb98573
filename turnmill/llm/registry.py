"""Registered queries of this subpackage and their DuckDB twins. Every
query reads its whole tables with the operators' production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.llm import burst_trie, decontaminate, gru_lm, language_id, line_windows, maxscore, mixing, packing, probminhash, quality, secret_scan, sharding, transducers
from turnmill.llm.common import crc_mod, read


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out fold."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod("doc_id", 3) == 1
    found = language_id.identify(docs.select("doc_id", "text"), docs.where(~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep probability and draw of every document under raked margins."""
    return mixing.mix_table(read(spark, sf_dir, "documents"))


def op3_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document, learned outside the held-out fold."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod("doc_id", 5) == 1
    found = gru_lm.score_texts(docs, docs.where(~held_out))
    return found.select(F.col("id").alias("doc_id"), *["n_tokens", "n_known", "train_tokens", "base_score", "score"]).withColumn(
        "held_out", held_out).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 best by inner product for every vector id divisible by 20."""
    return maxscore.neighbours(read(spark, sf_dir, "embeddings"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document as counts, a digest and spans."""
    return secret_scan.secret_table(read(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact shuffle of documents into 40 shards."""
    return sharding.shard_table(read(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of low quality and toxicity and the decision, per document."""
    return quality.quality_table(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its later copies of three-line windows."""
    return line_windows.dedup_lines(read(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its edit budget."""
    return decontaminate.leak_table(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and links of every document."""
    return probminhash.classes(read(spark, sf_dir, "documents")).drop("key")


def op11_transducers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best phrases of every language."""
    return transducers.phrases(read(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 ids."""
    from public_tokenizers import path

    return packing.pack(read(spark, sf_dir, "documents"), path("byte_bpe_50k.json"))


def op13_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all rebuilt conversations."""
    return burst_trie.trie_nodes(read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_mixing": op2_mixing,
    "op3_gru_lm": op3_gru_lm,
    "op4_maxscore": op4_maxscore,
    "op5_secrets": op5_secrets,
    "op6_sharding": op6_sharding,
    "op7_quality": op7_quality,
    "op8_line_windows": op8_line_windows,
    "op9_decontamination": op9_decontamination,
    "op10_probminhash": op10_probminhash,
    "op11_transducers": op11_transducers,
    "op12_packing": op12_packing,
    "op13_burst_trie": op13_burst_trie,
}

SQL: dict[str, str] = {
    "op2_mixing": mixing.sql(),
    "op4_maxscore": maxscore.SQL,
    "op8_line_windows": line_windows.SQL,
    "op11_transducers": transducers.SQL,
    "op13_burst_trie": burst_trie.SQL,
}
