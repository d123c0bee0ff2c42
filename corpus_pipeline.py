"""The training-data pipeline: documents in, packed sequences out.

``STAGES`` are applied in order; each gets what the one before it kept,
written as Parquet in the shared folder and read back, so a lost executor
costs no more than the running stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowtide.llm import decontam, packing, pii, quality_rules, simhash
from rowtide.llm.io import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class (3-word shingles, up to 3 bits)."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("personal data", personal_data),
    ("packing", pack),
]

#: learned rules, fingerprints and tokenizers are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns what the last one makes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
