"""The corpus pipeline: toxic documents go, one document of each group of near copies stays, documents
that overlap the benchmark go, secrets are masked, and what remains is packed into sequences.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``, whatever the stage before
it kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlens.llm import decontamination, near_dups, packing, secret_scan, toxicity
from driftlens.llm.common import stash, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject; it learns from labels outside the held-out fifth."""
    return toxicity.reject_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: a cosine of 0.8 or more between sets of five-word shingles, verified."""
    return near_dups.keep_one_of_each(docs)


def drop_benchmark_overlaps(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and ``n_chars`` following the text."""
    masked = secret_scan.redact_secrets(docs, secret_scan.train_forest(spark))
    n_chars = F.when(F.col("text").contains(secret_scan.MASK), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", n_chars)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_overlaps),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

#: SQL can express none of the first stages' models and fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
