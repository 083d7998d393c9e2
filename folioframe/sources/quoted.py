"""CSV files read by byte ranges, though quotes may hold line breaks.

Whether a line break ends a record depends on the quotes before it. Each range is scanned for both
cases, outside and inside a quoted field; the parity of the quotes of all earlier ranges tells
which one holds, and a second scan cuts the records.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioframe.sources.arrays import fragments

_RANGE = ["file_path", "range_start"]
_TOTALS = "file_path string, range_start bigint, flips int, ends array<bigint>"
_PIECES = "file_path string, range_start bigint, pos bigint, whole boolean, text string"


def csv_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(file_path, first, record)``: the records of CSV files as text; ``first`` marks the one that begins a file.

    A record is made in the task that reads it; those that go over a range's border are put
    together by a shuffle. A field that is still open where a file ends is closed there.
    """
    lines = fragments(spark, path, "\n").join(_range_states(spark, path), _RANGE)
    # a join by broadcast keeps the order, any other doesn't
    lines = lines.sortWithinPartitions(*_RANGE, "place").select(*_RANGE, "value", "inside", "before")
    pieces = lines.mapInArrow(_cut_out, _PIECES)
    whole = pieces.where("whole").select("file_path", "pos", "text")
    joined = (
        pieces.where("NOT whole").groupBy("file_path", "pos")
        .agg(F.array_sort(F.collect_list(F.struct("range_start", "text"))).alias("parts"))
        .select("file_path", "pos", F.array_join("parts.text", "").alias("text"))
    )
    # every line was given its line break back
    record = F.regexp_replace("text", r"\r?\n\z", "")
    return whole.unionByName(joined).select("file_path", (F.col("pos") == 0).alias("first"), record.alias("record"))


def _range_states(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(file_path, range_start, inside, before)``: whether a range begins in quotes, and the records that ended before it."""
    totals = fragments(spark, path, "\n").select(*_RANGE, "value").mapInArrow(_totals, _TOTALS)
    earlier = Window.partitionBy("file_path").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2).cast("int")
    states = totals.withColumn("inside", inside).withColumn("ended", F.get("ends", "inside"))
    return states.select(*_RANGE, "inside", F.coalesce(F.sum("ended").over(earlier), F.lit(0)).alias("before"))


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range whether its quotes are odd, and the records that end in it, from outside and from inside quotes."""
    now, odd, ends = None, 0, [0, 0]

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([now[0]], pa.string()), pa.array([now[1]], pa.int64()), pa.array([odd], pa.int32()), pa.array([ends], pa.list_(pa.int64())),
        ], names=["file_path", "range_start", "flips", "ends"])

    for batch in batches:
        for *key, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if key != now:
                if now is not None:
                    yield out()
                now, odd, ends = key, 0, [0, 0]
            odd ^= text.count('"') & 1
            ends[odd] += 1  # a range that began outside ends a record when its quotes are even, and the other way round
    if now is not None:
        yield out()


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the ranges whose start is known; ``whole`` are those that begin and end in one."""
    rows: list[tuple] = []
    now, held, begun, inside, pos = None, [], False, 0, 0

    def out() -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
        columns = list(zip(*rows, strict=True))
        rows.clear()
        names = ["file_path", "range_start", "pos", "whole", "text"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        for *key, text, state, before in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if key != now:
                if held:
                    rows.append((*now, pos, False, "".join(held)))
                now, held, inside, pos = key, [], state, before
                # a record goes on from the range before only inside quotes
                begun = not inside
            inside ^= text.count('"') & 1
            held += (text, "\n")
            if not inside:
                rows.append((*key, pos, begun, "".join(held)))
                pos, held, begun = pos + 1, [], True
        if len(rows) >= 4096:
            yield out()
    if held:
        rows.append((*now, pos, False, "".join(held)))
    if rows:
        yield out()
