"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embeddings, host_rules, mixing, ngrams, pieces, pii, quality, simhash, suffixes, toxicity
from .store import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pii.pseudonymise(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "text", F.size("pii_kinds").cast("bigint").alias("n_values"), F.array_join(F.array_sort(F.array_distinct("pii_kinds")), ",").alias("kinds"))


def op2_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.select(table(spark, sf_dir, "documents"))


def op3_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.counted(suffixes.repeats(table(spark, sf_dir, "documents")))


def op4_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op6_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), digest=True)


def op7_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.scores(table(spark, sf_dir, "documents"))


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = host_rules.HostRules().apply(table(spark, sf_dir, "documents"))
    return got.select("doc_id", *host_rules.COUNTS, "base_failed", "kept")


def op9_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_rotation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op8_host_rules": host_rules.ORACLE, "op10_rotation_codes": embeddings.ORACLE, "op2_hierarchical_mix": mixing.ORACLE}
