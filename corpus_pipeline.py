"""The corpus pipeline: documents to token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows the one before has kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaextract.llm import bpe, decontaminate, jaccard, language, linededup
from deltaextract.llm.common import checkpointed, table

#: SQL has neither the compression nor the tokenizer: tests compare the stages with brute force instead.
ORACLE_SQL: str | None = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear, by dictionaries learned from all labelled ones."""
    return language.keep_known(docs, language.fit(docs))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that an earlier one has; ``n_chars`` follows the text."""
    cleaned = linededup.dedup_lines(docs)
    return cleaned.withColumn("n_chars", F.when(F.col("removed_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.keep_one(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers), their number, and a digest of the text they decode to."""
    out = bpe.encode_documents(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("word_bpe_49k.json"), decoded="decoded")
    return out.select("doc_id", "lang", "source", bpe.n_tokens(F.col("ids")).cast("long").alias("n_tokens"), "ids", F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [
    ("language", known_language),
    ("line dedup", without_repeated_lines),
    ("jaccard join", one_of_each_class),
    ("decontamination", without_benchmarks),
    ("bpe", as_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
