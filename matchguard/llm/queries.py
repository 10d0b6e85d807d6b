"""The dealt operators as queries with production parameters, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, dialogue_repair, embed_dedup, html_render, lm_score, nearest, ngram_join, spelling, sstable, token_count, toxicity
from .common import scratch

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    """A public vocabulary file; MATCHGUARD_TOKENIZERS may name another folder."""
    root = os.environ.get("MATCHGUARD_TOKENIZERS")
    if root:
        return os.path.join(root, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write documents as sorted-string-table shards, read them back, digest what was read."""
    uri = scratch(spark, "sstable")
    sstable.write_sstables(table(spark, sf_dir, "documents"), uri, tokenizer_path("word_bpe_49k.json"), end_id=2)
    return sstable.sstable_digests(spark, uri)


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.NoisyOr:
    return toxicity.fit(docs, table(spark, sf_dir, "labels"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noisy-or scores of all documents, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_documents(docs, toxicity_model(spark, sf_dir, docs))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), "n_sentences", "n_offending")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-likelihood of all documents, by a network trained on all of them."""
    docs = table(spark, sf_dir, "documents")
    net, tables = lm_score.fit(docs)
    return lm_score.score_documents(docs, net, tables)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.93 or more between vectors of one label, by the inverted multi-index."""
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.93)


def op5_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as each of its participants sees it."""
    return chat.rotate(table(spark, sf_dir, "conversations"), turns_per_piece=64)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of five-word shingles have Jaccard 0.8 or more."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), percent=80)


def op7_html_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of all pages, laid out."""
    return html_render.extract(table(spark, sf_dir, "pages"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), max_tokens=4096)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items whose question and answer they hold."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), split_pattern())


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words one edit apart under their frequent forms, after misspellings were planted in all texts."""
    words = spelling.count_words(table(spark, sf_dir, "documents"), min_len=6, min_count=5, typos=199)
    return spelling.group_variants(words, ratio=5)


def op12_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repairs of all conversations, after faults were planted in them."""
    return dialogue_repair.repair(dialogue_repair.damage(table(spark, sf_dir, "conversations")))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every vector whose id 100 divides, by the inverted multi-index."""
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


QUERIES: dict[str, Query] = {
    "op1_sstable": op1_sstable,
    "op2_toxicity": op2_toxicity,
    "op3_lm_score": op3_lm_score,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_chat_rotation": op5_chat_rotation,
    "op6_ngram_join": op6_ngram_join,
    "op7_html_render": op7_html_render,
    "op8_token_counts": op8_token_counts,
    "op9_decontamination": op9_decontamination,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_dialogue_repair": op12_dialogue_repair,
    "op13_nearest": op13_nearest,
}

SQL: dict[str, str] = {"op5_chat_rotation": chat.SQL, "op6_ngram_join": ngram_join.SQL, "op11_spelling_variants": spelling.SQL, "op12_dialogue_repair": dialogue_repair.SQL}
