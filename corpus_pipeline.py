"""Corpus pipeline: quality rules, language ID, SimHash near-dedup, source
mixing, best-fit packing. Each stage takes (spark, docs, sf_dir); its result is
written as Parquet and reread as the next stage's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from edumart.llm.common import materialize, table
from edumart.llm.language_id import filter_language
from edumart.llm.mixing import sample_mix
from edumart.llm.packing import pack_apart
from edumart.llm.quality_rules import filter_quality
from edumart.llm.simhash import MAX_BITS, SHINGLE_WORDS, drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filter_quality(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filter_language(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, k=SHINGLE_WORDS, bits=MAX_BITS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sample_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_apart(docs)


STAGES = [("quality_rules", quality), ("language_id", language), ("simhash_dedup", dedup),
          ("source_mixing", mixing), ("best_fit_packing", packing)]

#: language ID, fingerprints and packing have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
