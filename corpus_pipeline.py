"""A corpus from ``documents``: judged, deduplicated, decontaminated, mixed and sharded.

Every stage takes (spark, docs, sf_dir), is written as Parquet to the shared
folder, and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, extendible, mil_quality, simhash_trie, soft_mix
from millrace.llm.common import table
from millrace.llm.queries import SHARD_BYTES, THRESHOLD, WINDOW
from millrace.session import stage

#: Token shares after the quality stage, which leaves few poor documents.
MIX = {"fine": 0.82, "poor": 0.06, "toxic": 0.12}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold."""
    return mil_quality.keep_good(docs, table(spark, sf_dir, "labels"), THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of smallest id of each group of near copies (five words, similarity 0.8), null ids last."""
    return simhash_trie.keep_first_similar(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"), WINDOW)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their fitted rates say."""
    return soft_mix.mixed(docs, soft_mix.domains_of_labels(table(spark, sf_dir, "labels")), MIX)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard that they go to."""
    return extendible.assign_shards(docs, SHARD_BYTES)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminated", decontaminated),
    ("mixed", mixed),
    ("sharded", sharded),
]

#: SQL has neither the trained models nor the hash; tests/llm compares run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
