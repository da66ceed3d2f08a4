"""Corpus pipeline: language, exact copies, near copies, benchmark leaks, source mix.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame; its
result is written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourgrid.llm import decontaminate, exact_dedup, jaccard_join, language_id, source_mix
from hourgrid.llm.frames import ship_code, stage, table

# A text whose best language is less likely than this is of no known language.
LEAST_LANGUAGE_SCORE = 0.35


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; those without a letter or with a low score go.

    The model learns from all labelled documents that reach this stage.
    """
    ship_code(spark)
    model = language_id.train(docs)
    return language_id.keep_known(docs, model, LEAST_LANGUAGE_SCORE)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by n-gram similarity the document with the smallest id stays."""
    ship_code(spark)
    return jaccard_join.drop_similar(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark question, also re-parameterised, go."""
    ship_code(spark)
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document with the number of copies that are taken of it."""
    return source_mix.mix_sources(docs)


STAGES = [
    ("language_id", keep_known_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("source_mix", mix_to_weights),
]

# Training, similarity joins and hashed luck have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
