"""Registered queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assayspark.llm import audit, centroids, chain, chat, decontam, linededup, lpf, mixing, quality, secrets, sharding, simhash, urlrules
from assayspark.session import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_table(table(spark, sf_dir, "documents"))


def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.repeated_passages(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_table(table(spark, sf_dir, "conversations"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lpf.repeat_table(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_table(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_table(table(spark, sf_dir, "documents"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.url_table(table(spark, sf_dir, "pages"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_table(table(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_table(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash, op2_repeated_passages, op3_mixing, op4_chat, op5_substring_dedup, op6_decontamination, op7_sharding, op8_secrets, op9_quality, op10_url_rules,
        op11_centroids, op12_line_dedup, op13_filter_audit,
    )
}
ORACLES = {
    "op3_mixing": mixing.MIX_SQL,
    "op4_chat": chat.CHAT_SQL,
    "op11_centroids": centroids.CLUSTER_SQL,
    "op12_line_dedup": linededup.LINE_SQL,
    "op13_filter_audit": audit.AUDIT_SQL,
}
