"""Token-id files in directly addressable codes: write in document order, read back, look up."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioframe.llm.direct_codes import access, decode, encode, packed, unpacked
from folioframe.llm.wordids import WordIds
from folioframe.llm.words import byte_column

_LEVELS = pa.list_(pa.struct([("chunks", pa.binary()), ("bitmap", pa.binary()), ("ranks", pa.binary())]))
_FILE = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
    ("n_ids", pa.int64()), ("levels", _LEVELS),
])
_FILE_SQL = (
    "part int, block int, doc_ids array<bigint>, lengths array<bigint>, n_ids bigint, "
    "levels array<struct<chunks: binary, bitmap: binary, ranks: binary>>"
)
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def write_token_ids(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, block_ids: int = 1 << 18,
    doc_id: str = "doc_id", text: str = "text",
) -> None:
    """Encode whole texts and write the ids to ``path`` in ascending ``doc_id`` order.

    The format is a Parquet folder with one row a block. A block holds the ids of whole documents,
    about ``block_ids`` of them, as directly addressable codes, with the documents' ids and
    lengths. Blocks sort by ``(part, block)``, and so do documents over blocks. ``end_id`` is
    appended to every document. A null text counts as empty; null ids come first; rows that
    repeat an id stay separate documents, ordered by text. ``tokenizer`` is the path of a
    tokenizers file that every executor has.
    """
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = WordIds(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4").tobytes()
        block, ids, lengths, held, n = 0, [], [], [], 0
        for batch in batches:
            for one, data in zip(batch.column("doc_id").to_pylist(), byte_column(batch, "text"), strict=True):
                coded = words(data.decode("utf-8", "replace")) + end
                ids.append(one)
                lengths.append(len(coded) // 4)
                held.append(coded)
                n += lengths[-1]
                if n >= block_ids:
                    yield _block(part, block, ids, lengths, held)
                    block, ids, lengths, held, n = block + 1, [], [], [], 0
        if ids:
            yield _block(part, block, ids, lengths, held)

    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, _FILE_SQL).write.option("compression", "zstd").parquet(path)


def _block(part: int, block: int, ids: list, lengths: list[int], held: list[bytes]) -> pa.RecordBatch:
    levels = packed(encode(np.frombuffer(b"".join(held), "<u4")))
    row = {"part": part, "block": block, "doc_ids": ids, "lengths": lengths, "n_ids": sum(lengths), "levels": levels}
    return pa.RecordBatch.from_pylist([row], schema=_FILE)


def token_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a folder with ``first``, the number of ids before each.

    What comes before a part is summed over the totals of the parts, a row for each task of the
    writer; inside a part a window runs over its blocks.
    """
    blocks = spark.read.schema(T._parse_datatype_string(_FILE_SQL)).parquet(path)
    sizes = blocks.select("part", "block", "n_ids")
    totals = sorted((r["part"], r["n"]) for r in sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before = np.cumsum([0] + [n for _, n in totals]).tolist()
    parts = spark.createDataFrame([(part, before[i]) for i, (part, _) in enumerate(totals)], "part int, ids_before bigint")
    running = F.sum("n_ids").over(_in_part()) - F.col("n_ids")
    firsts = sizes.withColumn("running", running).join(parts, "part").select(
        "part", "block", (F.col("running") + F.col("ids_before")).alias("first")
    )
    return blocks.join(firsts, ["part", "block"])


def _in_part():
    return Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files alone.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is over its ids as
    little-endian unsigned 32-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                data = memoryview(decode(unpacked(one["levels"])).astype("<u4").tobytes())
                lengths = one["lengths"]
                ends = np.cumsum(lengths, dtype=np.int64)
                starts = ends - lengths
                sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(one["doc_ids"], pa.int64()), pa.array(starts + one["first"], pa.int64()),
                    pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()),
                ], schema=_READ)

    blocks = token_blocks(spark, path).select("doc_ids", "lengths", "levels", "first")
    return blocks.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_at(spark: SparkSession, path: str, positions: DataFrame, stride: int = 1 << 18) -> DataFrame:
    """``(position, token)`` for a table of corpus-wide positions, by random access into blocks.

    Positions outside the files give no row. Positions and blocks meet by an equi-join on the
    stride of ``stride`` ids they lie in, so that only touched blocks are read out.
    """
    blocks = token_blocks(spark, path)
    last = F.col("first") + F.col("n_ids") - 1
    bounds = blocks.select(
        "first", "n_ids", "part", "block",
        F.explode(F.sequence(F.floor(F.col("first") / stride), F.floor(last / stride))).alias("stride"),
    )
    keyed = positions.select(F.col("position").cast("bigint").alias("position")).withColumn(
        "stride", F.floor(F.col("position") / stride)
    ).join(bounds, "stride").where((F.col("position") >= F.col("first")) & (F.col("position") <= last))
    grouped = keyed.groupBy("part", "block", "first").agg(F.sort_array(F.collect_list("position")).alias("positions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.to_pylist():
                levels = unpacked(one["levels"])
                yield pa.RecordBatch.from_arrays([
                    pa.array(one["positions"], pa.int64()),
                    pa.array([access(levels, p - one["first"]) for p in one["positions"]], pa.int64()),
                ], names=["position", "token"])

    touched = grouped.join(blocks.select("part", "block", "levels"), ["part", "block"])
    return touched.select("first", "positions", "levels").mapInArrow(run, "position bigint, token bigint")
