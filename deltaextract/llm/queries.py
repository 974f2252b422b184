"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaextract.llm import ann, bpe, byte_bpe, decontaminate, filteraudit, jaccard, language, license, linededup, lm, resample, reshard, toxicity
from deltaextract.llm.common import fold_of, table

OLD_SHARDS, SHARDS = 32, 40


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), decoded="decoded")
    return out.select(
        "doc_id", bpe.n_tokens(F.col("ids")).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256")
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license.scan(docs, license.fit(docs)).select("doc_id", "n_paragraphs", "families", "licenses")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(fold_of(F.col("doc_id"), 4) != 2))
    found = docs.select("doc_id", language.predict(model, F.col("text")).alias("found"))
    return found.select(
        "doc_id", (fold_of(F.col("doc_id"), 4) == 2).alias("held_out"), F.col("found.lang").alias("lang_pred"), "found.score", "found.margin", "found.rejected"
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.fit(docs.where(fold_of(F.col("doc_id"), 5) != 0), table(spark, sf_dir, "labels"))
    found = docs.select("doc_id", toxicity.score(lexicon, F.col("text")).alias("found"))
    return found.select("doc_id", (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), "found.score", "found.predicted", "found.matches")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "row.doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = reshard.reshard_documents(table(spark, sf_dir, "documents"), OLD_SHARDS, SHARDS)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard"
    )


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(ann.index(vectors), vectors.where(F.col("vec_id") % 50 == 0))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = byte_bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN)
    decode = byte_bpe.decoder(spark, ranks)
    return out.select("doc_id", byte_bpe.n_tokens(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(decode(F.col("ids")), 256).alias("decoded_sha256"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = resample.importance(docs, table(spark, sf_dir, "benchmark").select("text"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return filteraudit.audit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe": op1_bpe,
        "op2_licenses": op2_licenses,
        "op3_language": op3_language,
        "op4_toxicity": op4_toxicity,
        "op5_decontamination": op5_decontamination,
        "op6_sharding": op6_sharding,
        "op7_ann": op7_ann,
        "op8_line_dedup": op8_line_dedup,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_lm_scoring": op10_lm_scoring,
        "op11_byte_bpe": op11_byte_bpe,
        "op12_resampling": op12_resampling,
        "op13_filter_audit": op13_filter_audit,
    }
