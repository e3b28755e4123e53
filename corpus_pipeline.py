"""The corpus pipeline: language ID, exact and SimHash deduplication, decontamination, encoding.

Each stage takes ``(spark, docs, sf_dir)``. All but the last return the columns
of ``documents``; ``run`` writes every stage as Parquet in the shared folder and
hands it, reread, to the next one, so a lost executor costs no more than the
stage it worked on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsflow.llm import bpe, decontaminate, exact_dedup, language_id, simhash_dedup
from newsflow.llm.common import materialised, table
from newsflow.llm.queries import vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language stays in doubt, go."""
    return language_id.accepted(docs, language_id.train(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest ``doc_id`` stays."""
    return exact_dedup.first_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, that with the smallest ``doc_id``.

    Fingerprints of 3-word shingles link at 3 or fewer differing bits, as the
    SimHash operator's contract sets; the bit distance alone decides.
    """
    return simhash_dedup.first_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    return bpe.digests(docs, vocabulary())


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", decontaminated),
    ("bpe", encoded),
]

# Language ID, XXH64 fingerprints and byte-pair encoding have no SQL form; the
# stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
