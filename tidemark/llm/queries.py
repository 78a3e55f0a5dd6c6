"""One query per corpus operator, applied with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm import decontam, licenses, linededup, packing, quality, repeats, secrets, simhash, tokencount, urlfilter
from tidemark.llm.oracles import ORACLES  # noqa: F401
from tidemark.sources.tables import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op2_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokencount.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality(docs, quality.calibrated(docs, table(spark, sf_dir, "labels")))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_dedup(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.document_licenses(table(spark, sf_dir, "documents"))


def op7_long_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_token_count": op2_token_count,
    "op3_url_filter": op3_url_filter,
    "op4_quality_rules": op4_quality_rules,
    "op5_line_dedup": op5_line_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_long_repeats": op7_long_repeats,
    "op8_packing": op8_packing,
    "op9_simhash": op9_simhash,
    "op10_decontamination": op10_decontamination,
    "pipeline": corpus_pipeline.run,
}

if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
