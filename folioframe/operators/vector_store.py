"""A content-addressed table of text vectors: each text is encoded once an encoder, in all runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.operators.hooks import Encode, encode_texts

_SCHEMA = "digest string, vector array<float>, encoder string"


def stored_vectors(spark: SparkSession, store: str) -> DataFrame:
    """``(digest, vector, encoder)`` of a store, which is partitioned by encoder; empty before its first use."""
    try:
        return spark.read.schema(_SCHEMA).parquet(store)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], _SCHEMA)


def store_vectors(texts: DataFrame, encoders: Mapping[str, Callable[[], Encode]], store: str, text: str = "text") -> DataFrame:
    """Encode the distinct texts that the store lacks, append them, and give the store back.

    A text's address is its ``sha2(text, 256)`` with the encoder's name. Nothing stands between
    the encoder and the file, so a lost executor costs the texts of its own tasks only. Null
    texts have no vector; one that an encoder failed on isn't stored and is tried again in the next run.
    """
    spark = texts.sparkSession
    for name, make in encoders.items():
        known = stored_vectors(spark, store).where(F.col("encoder") == name).select("digest")
        fresh = texts.where(F.col(text).isNotNull()).select(F.sha2(text, 256).alias("digest"), F.col(text).alias("text"))
        lacking = fresh.join(known, "digest", "left_anti").select("text")
        vectors = encode_texts(lacking, make).where("vector IS NOT NULL")
        vectors.withColumn("encoder", F.lit(name)).write.mode("append").partitionBy("encoder").parquet(store)
    return stored_vectors(spark, store)
