"""Registered queries of the training-data operators; each derives its columns from its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm.alignment import align_tokenizers
from folioframe.llm.compression_bands import quality_rules
from folioframe.llm.leaks import benchmark_leaks
from folioframe.llm.licenses import scan_licenses
from folioframe.llm.near_duplicates import near_duplicates
from folioframe.llm.packing import pack_documents
from folioframe.llm.perspectives import render_perspectives, span_text
from folioframe.llm.phrases import mine_phrases
from folioframe.llm.repeats import repeated_passages
from folioframe.llm.simhash import simhash_groups
from folioframe.llm.token_counts import count_tokens
from folioframe.llm.token_ids import read_documents, write_token_ids
from folioframe.llm.toxicity import held_out, train_toxicity
from folioframe.session import scratch_path


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file; executors have the same package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return model.score(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = render_perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return rendered.withColumn("spans", span_text("spans"))


def op3_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir), 35).drop("spans")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), 1)


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmark_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 10)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    write_token_ids(documents(spark, sf_dir), path, vocabulary("word_bpe_49k.json"), 1)
    return read_documents(spark, path)


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), 4, 80)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(documents(spark, sf_dir), 10, 3, 2000)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir), 3, 3)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_perspectives": op2_perspectives,
    "op3_compression_bands": op3_compression_bands,
    "op4_repeated_passages": op4_repeated_passages,
    "op5_token_counts": op5_token_counts,
    "op6_license_scan": op6_license_scan,
    "op7_packing": op7_packing,
    "op8_winnowing": op8_winnowing,
    "op9_token_ids": op9_token_ids,
    "op10_minhash": op10_minhash,
    "op11_phrases": op11_phrases,
    "op12_alignment": op12_alignment,
    "op13_simhash": op13_simhash,
}
