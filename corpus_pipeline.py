"""From raw documents to token ids: toxic documents go, one of each group of near
copies stays, documents that hold benchmark items go, the rest is encoded.

Each stage takes (spark, docs, sf_dir), reads what the stage before it kept, and
returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchguard.llm import bpe, decontaminate, ngram_join, toxicity
from matchguard.llm.common import discard, materialize
from matchguard.llm.queries import split_pattern, table, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or score is below 0.3, by a model of the labels not held out."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model, threshold=0.3)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return ngram_join.keep_one(docs, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_unleaked(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of each document's ids and of what they decode to."""
    return bpe.round_trip_digests(docs, tokenizer_path("byte_bpe_50k.tiktoken"), split_pattern())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("byte_bpe", encode),
]

#: SQL has no trained classifier; the stages are tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again; a stage's table goes once the next is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        kept = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
