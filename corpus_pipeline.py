"""The corpus pipeline: documents to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows that its
predecessor kept and, but for the last, returns the columns of ``documents``.
Stages are written as Parquet and read again between each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.common import table, written
from kiln.llm.decontamination import decontaminate
from kiln.llm.packing import pack
from kiln.llm.pii import redact
from kiln.llm.quality import quality_filter
from kiln.llm.queries import VOCABULARY
from kiln.llm.simhash import drop_near_duplicates


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    out = redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2,048 tokens."""
    return pack(docs, VOCABULARY)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Tokens, fingerprints and the tagger have no SQL form; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
