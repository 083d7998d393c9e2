"""Corpus pipeline over ``documents``: quality rules, near-dedup, substring dedup, decontamination, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame; all but the last return the columns
of ``docs``. Document ids should be unique; rows without an id pass every stage on their text alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioframe.llm.compression_bands import keep_quality
from folioframe.llm.leaks import drop_leaks
from folioframe.llm.near_duplicates import drop_near_duplicates
from folioframe.llm.packing import pack_documents
from folioframe.llm.queries import vocabulary
from folioframe.llm.repeats import cut_repeated_passages
from folioframe.session import cut, local_shared_dir

#: Words of a shingle in the near-duplicate stage, hundredths of similarity, words of a repeated passage.
SHINGLE, SIMILARITY, PASSAGE = 5, 80, 35
WIDTH, END_ID, VOCABULARY = 2048, 1, "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the compression bands."""
    return keep_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of every group of near-duplicates."""
    return drop_near_duplicates(docs, SHINGLE, SIMILARITY)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated passages; ``n_chars`` follows."""
    return cut_repeated_passages(docs, PASSAGE)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most ``WIDTH`` tokens."""
    return pack_documents(docs, vocabulary(VOCABULARY), END_ID, WIDTH)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]

# Compression ratios and tokenizers are beyond SQL; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the documents, each written as Parquet and read again for the next."""
    local_shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
