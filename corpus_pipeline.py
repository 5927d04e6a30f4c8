"""The corpus pipeline: stages over ``documents``, each calling one operator of ``ticketloom.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ticketloom.llm.bpe import round_trip
from ticketloom.llm.langid import with_known_language
from ticketloom.llm.mixing import mixed_documents
from ticketloom.llm.simhash import one_per_group
from ticketloom.llm.toxicity import without_toxic
from ticketloom.session import settle_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the classifier is fitted on the labelled ones among ``docs``."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those far from every language, go."""
    return with_known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    return one_per_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by the weights 1, 2, 3, at most three times each; whole documents, repeated."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document of the mix as ids, with the digests of the ids and of what they decode to."""
    return round_trip(docs, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity), ("language", language), ("near_duplicates", near_duplicates), ("mix", mix), ("tokens", tokens)]

#: The stages fit models and tokenise, which SQL cannot express; tests/llm compares each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
