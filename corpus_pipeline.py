"""The training-data pipeline: stages over documents, each written as Parquet and read again for the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import decontaminate, line_dedup, ngram_join, pieces, toxicity
from paperloom.llm.common import shared_dir, table
from paperloom.llm.queries import MODEL


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that the classifier calls toxic; it learns from all of the sf_dir's labelled rows
    outside the held-out fold. Each row is judged by its own text."""
    return toxicity.without_toxic(docs, toxicity.fit(toxicity.sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))))


def boilerplate_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the boilerplate lines of their source out of the text, and n_chars of what is left.

    A text that is boilerplate as a whole is a copy, which the next stage judges, so it stays as it is.
    """
    out = line_dedup.strip_lines(docs, spare_copies=True)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return ngram_join.one_of_each(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those contaminated by benchmark passages."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, the ids of the text, and length, hash and round-trip flag of the ids decoded again."""
    return pieces.round_trip(docs, MODEL)


STAGES = [
    ("toxicity", toxic_out),
    ("line dedup", boilerplate_out),
    ("n-gram Jaccard join", copies_out),
    ("benchmark decontamination", benchmark_out),
    ("SentencePiece encoding", encoded),
]

#: No stage but the line dedup and the decontamination has an SQL form; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
