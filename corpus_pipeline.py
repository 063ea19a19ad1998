"""The corpus pipeline: documents in, packed training sequences out.

Five stages, each over all that its predecessor kept. Toxic documents go, one document of each group
of near duplicates stays, documents that hold benchmark items go, secrets are masked in place, and
what is left is packed. Each stage's result is written as Parquet to the shared folder and read
again; all but the last have the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimstar.llm import bpe, common, decontamination, packing, secrets, simhash, toxicity


def clean_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or toxicity is below the threshold."""
    model = toxicity.learn(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of SimHash near duplicates."""
    return simhash.representatives(docs, simhash.near_duplicates(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontamination.leaks(docs, common.table(spark, sf_dir, "benchmark"))
    return decontamination.without_leaks(docs, found)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secrets.redacted(docs, secrets.scan(docs), "row")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its place in a sequence."""
    return packing.pack(docs, bpe.vocabulary())


STAGES = [
    ("toxicity", clean_toxicity),
    ("simhash near-dedup", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack),
]

#: SQL can't express the stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
