"""The corpus pipeline: stages over ``documents``, each written before the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fareloom.llm.common import documents, ship, stored
from fareloom.llm.jaccard_join import Rule, one_of_each
from fareloom.llm.labelled import labelled_sample
from fareloom.llm.packing import pack
from fareloom.llm.site_quality import fit_quality, good_documents
from fareloom.llm.toxicity import fit_severity, without_toxic

# Near copies: shingles of five words, similarity 0.8.
NEAR = Rule(words=5, num=80, den=100)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose likeliest severity grade is 0."""
    ship(spark)
    sample = labelled_sample(docs, documents(spark, sf_dir, "labels"), "toxic")
    return without_toxic(docs, fit_severity(sample))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are good, seen with their path and host."""
    ship(spark)
    sample = labelled_sample(docs, documents(spark, sf_dir, "labels"), "quality")
    return good_documents(docs, fit_quality(sample))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    ship(spark)
    return one_of_each(docs, NEAR)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences."""
    ship(spark)
    return pack(docs, table_words=100_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_copies),
    ("packing", packing),
]

# Two stages hold fitted classifiers, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
