"""The corpus pipeline: language ID, near-dedup, PII, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cabflow.llm import langid, minhash, mixing, packing, pii
from cabflow.llm.common import stored, table


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the others go."""
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class (that with the smallest id)."""
    return minhash.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, whole and in part, to the target of their source."""
    return mixing.repeat(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in the training sequences."""
    return packing.pack_documents(docs)


STAGES = [("language_id", identify_languages), ("near_dedup", drop_near_duplicates), ("pii", redact_personal_data),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: Classifier, signature, random field and tokenizer are not SQL: see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's result is written to the
    shared folder as Parquet and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
