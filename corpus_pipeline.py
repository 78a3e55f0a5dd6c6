"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

``STAGES`` lists the stages in order.  Each takes (spark, docs, sf_dir) and returns a DataFrame; the next
one works on all that it kept.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, linededup, packing, quality, simhash
from tidemark.llm.common import cut
from tidemark.sources.tables import table

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the compression bands are drawn from the labelled documents."""
    return quality.kept_documents(docs, quality.calibrated(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites go, but for their first occurrence."""
    return linededup.without_boilerplate(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; documents that are mostly such go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces in training sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_dedup", simhash_dedup), ("decontamination", decontamination), ("packing", pack)]

#: Compression, near-duplicate chains and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the lineage is cut between them in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
