"""From documents to training sequences: five stages, each one operator of hirelake.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelake.llm import decontaminate, exact_dedup, langid, packing, simhash
from hirelake.llm.common import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; trained on the labelled ones among docs."""
    return langid.accepted(docs, langid.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the largest id."""
    return exact_dedup.keep_distinct(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id."""
    return simhash.keep_one_of_each(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark_free),
    ("packing", sequences),
]

# Training, fingerprints and tokens are beyond SQL; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what one returns is written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
