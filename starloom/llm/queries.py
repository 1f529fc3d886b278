"""The operators' queries over the test tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, embed_join, html_text, mixing, ngram_join, oracles, quality, ranked_search, suffix_dedup, tokens, url_filter, whitening, word_bpe
from .storage import scratch, table


URL_RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document at least once, sources as even as four passes over any of them allow: one row for each time that a
    document is shown, in the order (pass, block, place)."""
    shown = mixing.mix(table(spark, sf_dir, "documents"), mixing.Target(repetition=4.0))
    return shown.select(F.col("row.doc_id").alias("doc_id"), "source", F.col("pass").cast("long").alias("pass"), F.round("weight", 9).alias("weight"), "block", "place")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("line_chars", "ngram_chars", "failed")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), ngram_join.Measure(words=3, percent=90))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to token files in the shared folder, and their checksums read back."""
    path = scratch(spark, "tokens")
    tokens.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.checksums(tokens.read(spark, path))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                F.lit(r"\### Assistant: </turn> ok").alias("text"))
    turns = rows.unionByName(own).withColumn("parts", chat.text_part(F.col("text")))
    return chat.digests(chat.format_chats(turns))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_join.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=8).drop("multiplicity")


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {f.__name__: f for f in (
    op1_url_filters, op2_source_mixing, op3_quality_rules, op4_suffix_dedup, op5_ngram_jaccard_join, op6_html_extraction, op7_token_files, op8_chat_formatting, op9_byte_bpe, op10_embedding_near_dedup,
    op11_ranked_search, op12_embedding_whitening, op13_word_bpe)}

ORACLE_SQL: dict[str, str] = {
    "op3_quality_rules": oracles.quality(quality.Limits()),
    "op5_ngram_jaccard_join": oracles.jaccard(3, 90),
    "op8_chat_formatting": oracles.CHAT,
    "op10_embedding_near_dedup": oracles.EMBEDDINGS,
    "op11_ranked_search": oracles.ranked_search(10),
}
