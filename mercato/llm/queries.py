"""Registered queries of the operators; each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mercato.llm import (
    bpe,
    byte_bpe,
    chat,
    collocations,
    decontam,
    embedding_dedup,
    ngram_jaccard,
    periodic_runs,
    pitman_yor,
    quality,
    records,
    token_counts,
    toxicity,
)
from mercato.llm.common import table


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.toxicity(docs, toxicity.train(docs, labels))


def op3_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.scores(table(spark, sf_dir, "documents"))


def op4_record_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.record_digests(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.linked_calls(*chat.calls_of_turns(table(spark, sf_dir, "conversations")))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.quality(docs, quality.QualityModel(docs, labels))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_repeats(table(spark, sf_dir, "documents"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encoding_digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_ngram_jaccard, op2_toxicity, op3_pitman_yor, op4_record_output, op5_token_counts, op6_tool_calls,
              op7_embedding_dedup, op8_quality, op9_decontamination, op10_bpe, op11_periodic_runs, op12_byte_bpe,
              op13_collocations)
}
