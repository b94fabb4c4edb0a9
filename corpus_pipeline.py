"""Training-data pipeline over ``documents``: rules, line and document deduplication, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before
kept.  All but the last return the columns of ``documents``: rejected documents
are gone and removed lines are gone from the texts.  :func:`run` writes each
stage's result as Parquet to shared storage and reads it again, so a lost executor
never repeats an earlier stage.

Nulls, empty texts, repeated rows and empty tables pass through the stages as their
operators define it; columns beyond those of ``documents`` stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagelake.llm import bpe, decontaminate, line_dedup, quality_rules, simhash
from pagelake.llm.common import staged, table
from pagelake.llm.queries import vocabulary_path


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove lines that fail a rule, and documents that are rejected."""
    return quality_rules.clean_documents(docs)


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove lines that are nearly equal to an earlier line of the corpus."""
    return line_dedup.clean_documents(docs, least_chars=0)


def deduplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group whose SimHash fingerprints (3-word shingles) are linked within 3 bits."""
    return simhash.keep_one(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove documents that hold a passage of a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each remaining text, with the decoded text."""
    return bpe.encode_documents(docs, vocabulary_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", apply_quality_rules),
    ("line_dedup", deduplicate_lines),
    ("simhash_near_dedup", deduplicate_documents),
    ("decontamination", remove_leaks),
    ("bpe_encode", encode),
]

#: MinHash lines, SimHash components and BPE are beyond SQL; tests hold :func:`run` against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
