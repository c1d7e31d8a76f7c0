"""The corpus pipeline: languages, near copies, benchmark leaks, mixing, token output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import language, leaks, mixing, queries, simhash, tokens
from gleaner.session import scratch_path, table

MIN_LANGUAGE_SCORE = 0.25


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without text or letters, or with no language above ``MIN_LANGUAGE_SCORE``, go."""
    kept = docs.columns
    labelled = language.identify(docs, language.fit(docs), keep=[*kept])
    return labelled.filter((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(*kept)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one that names the group, once."""
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return leaks.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.apply_mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and what they say of each document."""
    return tokens.token_output(docs, queries.tokenizer_path())


STAGES = [
    ("language_id", language_stage),
    ("simhash", near_copy_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_output", token_stage),
]

ORACLE_SQL = None  # networks, fingerprints, sampling and tokens are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
