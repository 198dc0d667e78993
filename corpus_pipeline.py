"""The corpus pipeline: documents in, a deduplicated, decontaminated and mixed corpus out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's documents. Null and empty texts pass the stages as their
operators define; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riverglass.llm import decontaminate, line_crf, line_dedup, mixing, simhash_bktree
from riverglass.llm.common import stored
from riverglass.llm.queries import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field scores 0.3 or more, fitted on the labelled ones among `docs`."""
    return line_crf.keep_good(docs, table(spark, sf_dir, "labels"), least=0.3)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go, with documents of which nothing is left."""
    return line_dedup.dedup_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash_bktree.keep_one(docs, shingle=3, seed=42, radius=2)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them; `copy` counts those taken twice."""
    return mixing.mix(docs, weights=(3, 1, 2), share=1.5, most=2.0)


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies),
          ("benchmark_free", benchmark_free), ("mix", mix)]

# SQL cannot express the quality and near-copy stages; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
