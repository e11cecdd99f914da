"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontamination, licenses, line_crf, near_dedup, oracles, packing, quality_rules, secrets, substring_dedup, suffix_dedup, warc


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": lambda s, d: substring_dedup.digest(_docs(s, d)),
    "op2_quality_rules": lambda s, d: quality_rules.digest(_docs(s, d)),
    "op3_line_crf": lambda s, d: line_crf.scored(_docs(s, d), s.read.parquet(f"{d}/labels.parquet")),
    "op4_decontamination": lambda s, d: decontamination.overlaps(_docs(s, d), s.read.parquet(f"{d}/benchmark.parquet")),
    "op5_near_dedup": lambda s, d: near_dedup.linked(_docs(s, d), shingle=4),
    "op6_packing": lambda s, d: packing.packed(_docs(s, d), _tokenizer()),
    "op7_warc": lambda s, d: warc.derivatives(s.read.parquet(f"{d}/pages.parquet")),
    "op8_licenses": lambda s, d: licenses.scanned(_docs(s, d)),
    "op9_secrets": lambda s, d: secrets.digest(_docs(s, d)),
    "op10_suffix_dedup": lambda s, d: suffix_dedup.digest(_docs(s, d)),
}
ORACLES = {
    "op1_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op2_quality_rules": quality_rules.ORACLE,
    "op4_decontamination": oracles.DECONTAMINATION,
    "op5_near_dedup": oracles.NEAR_DEDUP,
    "op8_licenses": oracles.LICENSES,
    "op9_secrets": secrets.ORACLE,
    "op10_suffix_dedup": oracles.SUFFIX_DEDUP,
}
