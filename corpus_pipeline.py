"""The corpus pipeline: toxicity, quality, near duplicates, decontamination, token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; ``docs`` has the columns of ``documents``. The first four return rows of
``docs`` with all columns, the last returns the encodings' digests:

* toxicity: drops documents that the ordinal model calls toxic;
* quality: drops documents whose perplexity is above their language's threshold;
* near_duplicates: of each component of linked documents, the one with the
  smallest id stays. Documents without words or without an id stay;
* decontamination: drops documents in which a window of a benchmark item occurs;
* tokens: ids and decoded text of every document left.

Null and empty texts pass all filters. Rows that repeat a kept id stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import bpe, decontam, ngram_jaccard, quality, toxicity
from mercato.llm.common import broadcasts_end, scratch_path, small, table
from mercato.llm.queries import tokenizer_file

#: Fewer rows of a batch than in the single queries: Python workers and the JVM keep memory of the stages before.
BATCH_ROWS = 500
KEPT_PIECES = 20_000
TEXTS = 100


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels", BATCH_ROWS)))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.without_low_quality(docs, quality.QualityModel(docs, table(spark, sf_dir, "labels", BATCH_ROWS)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = ngram_jaccard.stored_components(docs)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(small(gone, gone.count(), 32), "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark", BATCH_ROWS))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(docs, tokenizer_file("word_bpe_49k.json"), kept_pieces=KEPT_PIECES, texts=TEXTS,
                                forget=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("tokens", token_ids),
]

#: Fitted models and the tokenizer are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents", BATCH_ROWS)
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        with broadcasts_end():  # models and sketches of a stage go when its table is there
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
