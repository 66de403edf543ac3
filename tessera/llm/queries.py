"""The registered queries of this subpackage: thin forms of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, html_extract, langid, license_scan, mixing, neardup, oracles, quality, sharding, suffix_dedup
from .common import table


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.members(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))[0]


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "group_pieces")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(table(spark, sf_dir, "conversations"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_html_extraction": op3_html_extraction,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_quality_rules": op6_quality_rules,
    "op7_sharding": op7_sharding,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_mixing": op9_mixing,
    "op10_language_id": op10_language_id,
}
ORACLES: dict[str, str] = {
    "op1_near_dedup": oracles.near_dedup(),
    "op4_suffix_dedup": oracles.suffix_dedup_of_texts(),
    "op5_license_scan": oracles.license_scan(),
    "op6_quality_rules": oracles.quality_rules(),
    "op9_mixing": oracles.mixing_of_sources(),
}
