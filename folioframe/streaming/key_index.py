"""Which files of a Parquet table may hold a key: a Bloom filter a file and key bucket, beside the table.

The filters are a table in the folder ``_keys`` of the table they belong to, which readers of the table
don't see, partitioned by zones of eight buckets of a key's hash. A file without filters counts as one
that may hold any key until it gets them, so a writer that died in between loses nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets of keys; a filter is held by one task with the others of its bucket.
BUCKETS, ZONE = 64, 8
_BITS, _PROBES = 10, 7
_BUILT = "file string, bucket int, hashes bigint, bits binary"
_SCHEMA = f"{_BUILT}, zone int"


def key_bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(F.lit("filter"), *keys)


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits of each hash in a filter of so many bits."""
    first = hashes.view(np.uint64)
    stride = (first >> np.uint64(32)) | np.uint64(1)
    return (first[:, None] + np.arange(_PROBES, dtype=np.uint64) * stride[:, None]) % np.uint64(size)


def make_filter(hashes: np.ndarray) -> bytes:
    """About ten bits a key: one in a hundred other keys passes, each of its own does."""
    size = 8 * (-(-_BITS * max(1, len(hashes)) // 8))
    marks = np.zeros(size, bool)
    marks[_places(hashes, size).ravel().astype(np.int64)] = True
    return np.packbits(marks).tobytes()


def any_passes(bits: bytes, hashes: np.ndarray) -> bool:
    marks = np.frombuffer(bits, np.uint8)
    places = _places(hashes, 8 * len(marks)).astype(np.int64)
    return bool(((marks[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1).all(axis=1).any())


def data_files(spark: SparkSession, path: str, schema: T.StructType) -> list[str]:
    """The files of a table as URIs, none if it isn't there; a path to read is what ``unquote`` makes of one."""
    try:
        return spark.read.schema(schema).parquet(path).inputFiles()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return []


def key_filters(spark: SparkSession, path: str) -> DataFrame:
    """``(file, bucket, hashes, bits, zone)`` of the indexed files of a table."""
    try:
        return spark.read.schema(_SCHEMA).parquet(f"{path}/_keys")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], _SCHEMA)


def _indexed(spark: SparkSession, path: str) -> set[str]:
    return {r["file"] for r in key_filters(spark, path).select("file").distinct().collect()}


def index_files(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> None:
    """Give filters to the files that have none; their keys are read once, as hashes."""
    known = _indexed(spark, path)
    fresh = [f for f in data_files(spark, path, schema) if f not in known]
    if not fresh:
        return
    rows = spark.read.schema(schema).parquet(*map(unquote, fresh)).select(
        F.input_file_name().alias("file"), key_bucket(keys).alias("bucket"), _key_hash(keys).alias("hash")
    )

    def build(table: pa.Table) -> pa.Table:
        hashes = np.unique(table.column("hash").to_numpy())
        return pa.table({
            "file": table.column("file")[:1], "bucket": table.column("bucket")[:1],
            "hashes": pa.array([len(hashes)], pa.int64()), "bits": pa.array([make_filter(hashes)], pa.binary()),
        })

    built = rows.groupBy("file", "bucket").applyInArrow(build, _BUILT).withColumn("zone", F.expr(f"bucket div {ZONE}").cast("int"))
    built.repartition("zone").write.mode("append").partitionBy("zone").parquet(f"{path}/_keys")
    empty = [(f, -1, 0, b"", -1) for f in sorted(set(fresh) - _indexed(spark, path))]
    if empty:
        spark.createDataFrame(empty, _SCHEMA).coalesce(1).write.mode("append").partitionBy("zone").parquet(f"{path}/_keys")


def _of_buckets(filters: DataFrame, buckets: Sequence[int]) -> DataFrame:
    zones = sorted({b // ZONE for b in buckets})
    return filters.where(F.col("zone").isin(zones) & F.col("bucket").isin(sorted(buckets)))


def files_with(batch: DataFrame, path: str, keys: Sequence[str]) -> list[str]:
    """The files of a table that may hold a key of ``batch``, as URIs.

    Only the filters of the batch's zones are read, and each bucket's keys meet them in one task;
    what comes back are file names, at most those of the table.
    """
    spark = batch.sparkSession
    files = data_files(spark, path, batch.schema)
    if not files:
        return []
    filters, known = key_filters(spark, path), _indexed(spark, path)
    if known.isdisjoint(files):
        return files
    hashed = batch.select(key_bucket(keys).alias("bucket"), _key_hash(keys).alias("hash")).distinct()
    buckets = [r["bucket"] for r in hashed.select("bucket").distinct().collect()]
    wanted = _of_buckets(filters, buckets).select("bucket", "file", "bits")

    def probe(asked: pa.Table, held: pa.Table) -> pa.Table:
        hashes = asked.column("hash").to_numpy()
        hits = [
            file.as_py() for file, bits in zip(held.column("file"), held.column("bits"), strict=True)
            if len(hashes) and any_passes(bits.as_py(), hashes)
        ]
        return pa.table({"file": pa.array(hits, pa.string())})

    found = hashed.groupBy("bucket").cogroup(wanted.groupBy("bucket")).applyInArrow(probe, "file string").distinct()
    may = {r["file"] for r in found.collect()}
    return [f for f in files if f in may or f not in known]
