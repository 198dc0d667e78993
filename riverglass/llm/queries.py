"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riverglass.llm import (
    conversation_repair, decontaminate, line_crf, line_dedup, merkle_manifest, mixing, multi_index,
    phrase_automata, rank_profiles, simhash_bktree, suffix_buckets, toxicity, warc)
from riverglass.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark, sf_dir):
    return toxicity.severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_simhash_bktree(spark, sf_dir):
    return simhash_bktree.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, seed=42, radius=2)


def op3_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"), work_dir(spark, "warc"))


def op4_decontamination(spark, sf_dir):
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_line_dedup(spark, sf_dir):
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op6_phrase_automata(spark, sf_dir):
    return phrase_automata.removal_report(table(spark, sf_dir, "documents"), window=50)


def op7_line_crf(spark, sf_dir):
    return line_crf.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), least=0.3)


def op8_mixing(spark, sf_dir):
    return mixing.mixing_plan(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)


def op9_multi_index(spark, sf_dir):
    return multi_index.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op10_suffix_buckets(spark, sf_dir):
    return suffix_buckets.removal_report(table(spark, sf_dir, "documents"), length=100)


def op11_conversation_repair(spark, sf_dir):
    return conversation_repair.repair_report(table(spark, sf_dir, "conversations"))


def op12_rank_profiles(spark, sf_dir):
    return rank_profiles.languages(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark, sf_dir):
    return merkle_manifest.proof_report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_simhash_bktree, op3_warc, op4_decontamination, op5_line_dedup, op6_phrase_automata,
    op7_line_crf, op8_mixing, op9_multi_index, op10_suffix_buckets,
    op11_conversation_repair, op12_rank_profiles, op13_merkle_manifest)}
