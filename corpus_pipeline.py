"""A training-data pipeline: five stages over ``documents``, each written and read again for the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import decontamination, jaccard_join, mixing, secrets, toxicity
from skyledger.llm.tables import table
from skyledger.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of the documents not held out."""
    labels = toxicity.learnable(table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, toxicity.learn(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: shingles of five words, similarity of 0.8 or more."""
    return jaccard_join.one_of_each(docs, jaccard_join.Similarity(5, 80, 100))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts give way to a mark; the documents stay."""
    return secrets.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with what it takes of them and where, in training order."""
    return mixing.taken_only(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_contaminated),
    ("secrets", mask_secrets),
    ("mix", mix_sources),
]

# A trained classifier and a randomness battery are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
