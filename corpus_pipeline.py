"""The corpus pipeline: each stage reads what its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meldstone.llm import bpe, decontamination, language_id, near_dedup, pii
from meldstone.llm.common import small_text_batches, table
from meldstone.sources.storage import materialise

RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a sufficient margin; the others go."""
    small_text_batches(spark)
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one of the smallest id."""
    return near_dedup.keep_one_of_each(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every span of personal data replaced by its kind."""
    small_text_batches(spark)
    return pii.redact(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their text, and the digest of what the ids decode to."""
    small_text_batches(spark)
    tokenizer = bpe.Tokenizer(spark, RANK_FILE, public_tokenizers.PATTERN)
    done = docs.select("doc_id", "lang", "source", tokenizer.round_trip(F.col("text")).alias("done"))
    return done.select(
        "doc_id",
        "lang",
        "source",
        F.expr("octet_length(done.ids) div 4").alias("n_tokens"),
        F.col("done.ids").alias("token_ids"),
        F.sha2("done.ids", 256).alias("ids_sha256"),
        F.sha2("done.decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("personal_data", remove_personal_data),
    ("tokens", tokenize),
]

#: Compression, components of near duplicates and merges cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each one returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
