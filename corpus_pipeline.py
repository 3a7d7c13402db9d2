"""A corpus from raw documents to token files, as stages that each read what the one before wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchlake.llm import mixing, near_dedup, suffix_arrays, token_files, toxicity
from matchlake.llm.queries import END_ID, table, tokenizer_file
from matchlake.session import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labelled ones doesn't call toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link with a similarity of 0.8 or more."""
    return near_dedup.without_near_duplicates(docs, near_dedup.Similarity(words=5, percent=80))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten consecutive words of a benchmark item occur."""
    return suffix_arrays.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, with weights 5, 2 and 1 and at most three times."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; one row for each document in them."""
    path = shared_folder(spark, "pipeline-tokens")
    token_files.write_tokens(docs, path, tokenizer_file(), END_ID)
    return token_files.token_digests(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", harmless),
    ("near duplicates", distinct),
    ("benchmark decontamination", without_benchmark),
    ("mixing to target weights", mixed),
    ("token ids", tokens),
]

#: The tokenizer and the trained models have no counterpart in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
