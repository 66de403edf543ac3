"""A corpus in five stages: quality rules, near-duplicates, benchmark leaks, mixing, shards.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it
kept; all but the last return the columns of documents as they came, others too, whatever
their names. No stage changes a text or reads a part of one. An empty table gives an empty
one of the same columns at every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, mixing, neardup, quality, sharding
from tessera.llm.common import checkpointed, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null and empty texts go, having under 50 words; repeated rows are judged one by one, rows without
    an id like others; without labels, or with too few, only the base rule rejects.
    """
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one of the least id.

    Of repeated rows (equal id and text) one stays; rows without an id all stay; null, empty and
    wordless texts are in no class with others, unless equal and not empty.
    """
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item.

    Null and empty texts and items match nothing; repeated rows are judged one by one; an empty
    benchmark keeps all.
    """
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, whole, twice at most.

    Null texts and those without a word are never taken; a null source is a source of its own, the
    last one; repeated rows have equal keys and are taken or left together at the end of a budget.
    """
    return mixing.repeated(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each row goes: its columns but the text, size, text_crc32, shard, slot and group_pieces.

    Null texts have size 8; null sources and languages are values like others; repeated rows may get
    any slot of their shards; of columns with the names of the results, the results stand.
    """
    return sharding.shard(docs, keep=[c for c in docs.columns if c not in ("doc_id", "text")])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
    ("shard", shard),
]
#: Exact binomial bounds, signatures and k-d splits are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = checkpointed(docs)
    return docs
