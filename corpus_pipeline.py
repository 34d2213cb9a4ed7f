"""The corpus pipeline: quality rules, near duplicates, benchmark decontamination,
mixing and sharding, each a thin stage over its operator in ``pulse.llm``.

``run`` writes every stage's result as Parquet in the shared checkpoint folder
and reads it back as the next one's input, so an executor lost later never
sends the work back past a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulse.llm import decontaminate, jaccard_join, mixing, quality, sharding
from pulse.llm.common import stash, table

SHARDS = 8
ORACLE_SQL = None       # the Jaccard join and the quality rules' hashes are not SQL; tests/llm checks run() by brute force


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose their removed lines (n_chars follows)."""
    return quality.clean_documents(docs, length_col="n_chars")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"), plain=True)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard."""
    return sharding.with_shard(docs, "doc_id", SHARDS)


STAGES = [("quality_rules", quality_stage), ("ngram_jaccard_join", near_duplicate_stage), ("decontamination", decontamination_stage),
          ("mixing", mixing_stage), ("sharding", sharding_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stash(docs)
    return docs
