"""The corpus pipeline: five operators in a row over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read
again as the next stage's ``docs``. All stages but the last return the columns of ``documents``, extra ones
and ones with any name included.

Defined cases: NULL and empty texts have no words and leave in the first stage. NULL ids are ordinary rows: the
second stage keeps one without an id only where no row of its group has one, the last stage writes them first.
Repeated rows are one group. NULL sources are a source of their own. Empty tables give empty results; without
labels only the base rules reject, without a benchmark nothing is contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerstar.llm import contamination, mixing, quality, simhash, token_planes
from ledgerstar.llm.common import cut, table
from ledgerstar.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the isolation forest keep."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates (3-word shingles, 3 bits)."""
    return simhash.keep_one(docs, shingle=3, distance=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return contamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files; one row per document of the mix, read back from them."""
    return token_planes.token_rows(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mix),
    ("token-ID / binary output", token_output),
]

# Isolation forests, XXH64 fingerprints and tokenizers have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs, f"pipeline-{k}")
    return docs
