"""The operators' queries over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, langid, licenses, lm, minhash, oracles, packing, pq, resharding, substrings, toxicity
from ._util import table, texts


def op1_pq_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op2_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op4_containment_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items of the benchmark against all documents."""
    return decontamination.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), threshold=0.8)


def op5_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From 12 shards to 16 of equal bytes."""
    dealt = resharding.reshard(table(spark, sf_dir, "documents"), old_shards=12, new_shards=16)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op6_word_first_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(table(spark, sf_dir, "documents"), train=~langid.held_out())
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op7_subword_bag_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train_rows=~toxicity.held_out())
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op8_chained_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.passages(table(spark, sf_dir, "documents"))


def op9_diagonal_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_log_frequency_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = lm.score(docs, lm.train(texts(docs.where(~lm.held_out()))))
    return scored.select("doc_id", lm.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pq_embedding_dedup": op1_pq_embedding_dedup,
    "op2_harmonic_packing": op2_harmonic_packing,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_containment_decontamination": op4_containment_decontamination,
    "op5_flow_resharding": op5_flow_resharding,
    "op6_word_first_langid": op6_word_first_langid,
    "op7_subword_bag_toxicity": op7_subword_bag_toxicity,
    "op8_chained_substring_dedup": op8_chained_substring_dedup,
    "op9_diagonal_license_scan": op9_diagonal_license_scan,
    "op10_log_frequency_bloom_lm": op10_log_frequency_bloom_lm,
}

#: The others train models, number places freely or align by chains; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_pq_embedding_dedup": oracles.OP1,
    "op3_minhash_near_dedup": oracles.OP3,
    "op4_containment_decontamination": oracles.OP4,
    "op9_diagonal_license_scan": oracles.OP9,
}
