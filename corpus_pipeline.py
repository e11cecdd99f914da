"""The corpus pipeline: quality rules, near-dedup, decontamination, secret scan, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; run() writes each result as
Parquet in the shared folder and reads it again.

All stages but the last return the columns of docs, in their order and with their types: text and n_chars hold what is
left, all others pass unchanged, whatever they are called (names that an operator uses inside included). Every stage reads
whole texts, however long, and gives an empty table for an empty one. What it does with nulls, ties and repeated rows is
told at each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, near_dedup, packing, quality_rules, secrets
from tidemark.llm._store import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and so do documents that lose too much or fail the base rules.

    Null, empty and blank texts go (they have fewer than 20 words). Rows are judged one by one, so repeated rows stay
    together or go together; a null in any other column doesn't matter."""
    return quality_rules.kept_documents(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8) stays: the one with the least doc_id.

    Rows that share a doc_id are one document, of which one row stays (any, where their other columns differ); what is
    near to one of its texts is in its group. Rows without a doc_id stay and are in no group. Null and empty texts have
    no words in common with anything and stay."""
    return near_dedup.kept_documents(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go.

    With a row go all rows of its doc_id; a row without a doc_id goes with those that have its text. Null and empty texts
    and items match nothing. Repeated items change nothing."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are replaced by their kind in brackets; copied examples stay.

    No row goes. A null text stays null; a null source counts as an owner of its own. Repeated rows are places of their
    own, but no further owners. Of spans that overlap the first one is replaced, and the rest of the others goes with
    it."""
    return secrets.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is an empty one, which is its end token alone. Every row has pieces of its own, so repeated rows and rows
    without a doc_id are packed one by one; pieces of equal length are told apart by a number of their row."""
    import public_tokenizers

    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: SQL can't express tokenization and signatures; the pipeline is tested against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
