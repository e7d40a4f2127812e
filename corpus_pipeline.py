"""Documents to training text: five stages, each one operator of ``termpeak.llm``.

A stage takes (spark, docs, sf_dir) and returns documents again, with the columns of
``documents``; the last one adds the probability with which a document was kept.

Defined results: a null text has no words and no lines and stays null; a null language or
source is one like any other; of rows without an id, equal texts are one group of which
one row stays; documents with null or empty text are one group of the SimHash stage.
Repeated rows fare alike up to that stage, which leaves one. Without labels of both kinds
nothing is toxic, without benchmark items nothing is contaminated, and an empty table
gives no rows. Columns beyond those of ``documents`` go along, whatever their names.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termpeak.llm.common import checkpoint_folder, table
from termpeak.llm.decontaminate import decontaminate
from termpeak.llm.line_dedup import dedup_lines
from termpeak.llm.mixing import sample_mix
from termpeak.llm.simhash import drop_near_duplicates
from termpeak.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for toxic go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def _with_n_chars(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier line go; ``n_chars`` follows the text."""
    return _with_n_chars(dedup_lines(docs))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark items go; of the others, only the words of
    hits; ``n_chars`` follows the text."""
    return _with_n_chars(decontaminate(docs, table(spark, sf_dir, "benchmark"), cut=True))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents with the target shares of tokens."""
    return sample_mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash", simhash),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# Classifier, components and raking are iterative; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
