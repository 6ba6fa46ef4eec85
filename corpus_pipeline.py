"""A corpus pipeline of five operators: quality rules, toxicity, SimHash near-duplicates, benchmark decontamination, packing.

Each stage is written as Parquet under the shared checkpoint folder and read
back as the next stage's documents.

Odd rows: a null or empty text has too few words, so its row goes in the first
stage; a null ``doc_id`` is kept like any other and loses only to a row with an
id in its group of near-duplicates; repeated rows, and rows of one id, are judged
one by one, and only the near-duplicates stage drops any of them, when they lie
in one group; a text of any length is judged whole; columns that ``documents``
has besides come out of all stages but the last as they went in; empty tables
give an empty result. Without labels of both classes no document is toxic by
score unless all labels are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadence.llm import decontam, quality, simhash, toxicity
from cadence.llm.queries import packed, table
from cadence.llm.store import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.kept_documents(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.7 or more go."""
    return toxicity.non_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id."""
    return simhash.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences that the kept documents are packed into, one row per piece."""
    return packed(docs)


STAGES = [("quality", quality_rules), ("toxicity", toxic_documents), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("packing", packing)]

#: SQL has neither the tokenizer, nor XXH64, nor the fitted classifier; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
