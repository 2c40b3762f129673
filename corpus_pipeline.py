"""The corpus pipeline: documents in, encoded documents out, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet
below the shared scratch folder and hands the re-read table to the next stage. All but the
last return the columns of ``documents``; each works on everything its predecessor kept. Once
a stage's result is written, its intermediate tables and the result before it are deleted.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dcflow.llm import decontam, linededup, quality, simhash, spcodec
from dcflow.llm.common import only_the_last, staged, table
from dcflow.session import remove_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list accept."""
    return quality.keep_good(docs, quality.learn_rules(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; so do documents that hold nothing else."""
    return linededup.drop_later_copies(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, decoded text and piece spans of what is left, as digests."""
    return spcodec.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: the last stage tokenises, which SQL cannot express; the stages are tested by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with only_the_last(spark) as made:
            docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            remove_path(spark, before)
        before = made[-1]
    return STAGES[-1][1](spark, docs, sf_dir)
