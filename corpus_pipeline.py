"""From raw documents to a training mix: the text operators as stages, one written table each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchtide.llm import decontaminate, language, mixing, sanitise, simhash
from merchtide.llm.common import boxed, held_out, prepared, table
from merchtide.sources.storage import stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: the model learns from the labelled ones not held out."""
    prepared(spark)
    model = language.fit(docs.where(~held_out()))
    rows = docs.select(boxed(docs), language.predicted(F.col("text"), model)["rejected"].alias("rejected"))
    return rows.where(~F.col("rejected")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return simhash.one_of_each(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and what gives it away replaced in their texts."""
    return sanitise.sanitise(docs, length="n_chars")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many copies of each document the mix takes."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_free),
    ("personal_data", without_personal_data),
    ("mixing", mixed),
]

# The language model and the fingerprints have no SQL form. The operators of the stages are tested
# one by one; no test runs the stages together.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
