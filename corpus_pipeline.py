"""From raw documents to token ids: language, near-duplicates, benchmark leaks, secrets, BPE.

Every stage works on all that the one before it kept. The first four return the columns of
``documents``; the last one returns a row of digests per document that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearthline.llm import bpe, decontamination, language_id, secret_scan, simhash
from hearthline.llm.common import ship_package, table, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and texts unlike any language learned from ``docs``."""
    ship_package(spark)
    return language_id.accepted(docs, language_id.fit(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates."""
    ship_package(spark)
    return simhash.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a test item or an edited copy of at least half of one."""
    ship_package(spark)
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, with its secrets masked."""
    ship_package(spark)
    return secret_scan.redacted(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the token ids, and the digest of the decoded text."""
    ship_package(spark)
    return bpe.digests(docs)


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("bpe", token_ids),
]

#: Hashes, alignments and learned centroids have no SQL form; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; each result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
