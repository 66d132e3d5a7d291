"""The corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input.

A stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
documents; the last adds how each document was sampled. ORACLE_SQL is None: a learned classifier has no SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm.common import Temporary, table
from tablewright.llm.decontamination import clean_documents
from tablewright.llm.line_dedup import deduplicated
from tablewright.llm.ngram_jaccard import distinct_documents
from tablewright.llm.quality_classifier import good_documents
from tablewright.llm.source_mixing import sample_documents

#: Near duplicates share at least this percentage of their shingles of so many words.
SHINGLE_WORDS, ALIKE_PERCENT = 5, 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that are equal or one edit apart from an earlier line; those of which nothing is left go."""
    return deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    return distinct_documents(docs, SHINGLE_WORDS, ALIKE_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with shares of tokens by source, language and length that are closer to each other than the input's."""
    return sample_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), Temporary()
    for _, stage in STAGES:
        now = Temporary()
        docs = now.staged(stage(spark, docs, sf_dir))
        before.release()  # what the stage before it kept
        before = now
    return docs
