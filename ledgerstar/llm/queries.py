"""The registered queries of the operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.llm import (chat, collocations, contamination, hilbert, importance, licences, mixing, pii, quality, simhash,
                            token_planes, toxicity, warc)
from ledgerstar.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard_documents(table(spark, sf_dir, "documents"))


def op4_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose texts are control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.read_back(chat.samples(turns.unionByName(odd)))


def op5_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_planes.token_rows(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op8_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_simhash, op3_hilbert_shards, op4_chat_windows, op5_token_planes, op6_pareto_mix,
    op7_licence_digests, op8_wu_manber, op9_personal_data, op10_toxicity,
    op11_collocations, op12_importance, op13_warc)}

ORACLE = {"op6_pareto_mix": mixing.ORACLE, "op7_licence_digests": licences.oracle(), "op8_wu_manber": contamination.ORACLE,
          "op11_collocations": collocations.oracle()}
