"""The corpus pipeline: toxicity, near duplicates, decontamination, mixing, token output.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and
returns a DataFrame; all but the last return the columns of ``documents``. ``run``
writes each stage's rows to the shared folder and reads them again for the next, so
that a lost executor never takes the pipeline back to its start.

SQL can't say the first stage (a trained model), so there is no oracle; the tests
hold each stage on its own input against what its rows must be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmill.llm import decontamination, mixing, similarity, tokens, toxicity
from gridmill.llm.common import keep, scratch, small_batches, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold; the model learns from the labelled
    rows of the input table, outside the held-out fold."""
    small_batches(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model, keep_rows=toxicity.THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    small_batches(spark)
    return similarity.keep_one_of_each(docs)


def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those that are mostly such passages go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture to target weights: a document as often as it is taken."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture, and what reading them back gives for each document."""
    small_batches(spark)
    return tokens.tokenize_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmark_passages),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
