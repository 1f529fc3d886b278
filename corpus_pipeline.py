"""From raw documents to token ids: quality rules, near and exact deduplication, mixing, tokens.

Each stage is a function (spark, docs, sf_dir) -> DataFrame on all rows that the one before kept.
All but the last return the columns of ``docs``, whatever they are besides doc_id, text and source.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe, mixing, ngram_join, quality, suffix_dedup
from starloom.llm.storage import stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    return quality.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 on five-word shingles, the one with the smallest id stays."""
    return ngram_join.one_of_each(docs, ngram_join.Measure(words=5, percent=80))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out what a document with a smaller id has too; n_chars, if there, is the new length."""
    left = suffix_dedup.without_repeats(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Flattens the shares of the sources: every document once, those of small sources up to 1.5 times as often."""
    return mixing.mixed_rows(docs, mixing.Target(repetition=1.5))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): token ids of each row, and the digest of what they decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = bpe.both_ways(docs, ranks, public_tokenizers.PATTERN)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("suffix-array dedup", without_repeats),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", encoded),
]

# Near-duplicate groups, suffix order and hashed permutations are beyond SQL on whole tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read back as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
