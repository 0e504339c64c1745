"""A corpus pipeline of five stages, each over all documents that the one before kept.

Toxic documents go, repeated lines go, one document of each group of near copies stays, documents that hold a benchmark
item go, and what is left is mixed to the sources' target weights. Stages take and return the columns of ``documents``; the last
adds ``copy``, the number of the draw. Every stage's result is written as Parquet and read by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagework.llm import decontam, line_dedup, mixing, ngram_join, toxicity
from passagework.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the model of the labels predicts to be toxic."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that other documents repeat, and their new length."""
    cut = line_dedup.dedup_lines(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return ngram_join.keep_one(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold an item of the benchmark."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# Toxicity scores, Bloom filters and random draws are no SQL; tests/llm compares the operators of stages 2 to 5 with SQL or brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
