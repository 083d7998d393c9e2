"""JSON array files read by byte ranges: several tasks share one file, however its lines are broken.

Spark's text source cuts a file at every ``}`` and so splits it at any size. What a piece means
depends on where it begins: inside a string or not, and how deep. So each range is scanned once for
both string states with depths counted from its start; prefix sums over the ranges of a file tell
which state holds and how many elements came before; a second scan then cuts the elements.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_ESCAPED = re.compile(r"\\.", re.DOTALL)
_RANGE = ["file_path", "range_start"]
_TOTALS = (
    "file_path string, range_start bigint, flips int, turned array<bigint>, "
    "ends array<struct<inside: int, depth: bigint, n: bigint>>"
)
_PIECES = "file_path string, range_start bigint, pos bigint, begun boolean, ended boolean, text string"
#: What may stand before the first and the other elements, and after the last one (with the ``}`` put after every piece).
_FIRST, _LATER, _REST = r"^\s*\[\s*(?=\{)", r"^\s*,\s*(?=\{)", r"^\s*\]\s*\}$"
_EMPTY = r"^\s*\[\s*\]\s*\}$"


def array_elements(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """``(file_path, pos, element, fits)``: the objects of JSON array files, and one row for what follows them.

    ``element`` is the object's text and ``fits`` whether what stands before it may stand there.
    The last row of a file has a null ``element``; there ``fits`` is whether the file ends as an
    array does. An object's row is made in the task that reads it; only objects
    that go over a range's border are put together by a shuffle. Elements that aren't objects
    don't fit. A file without such a last row has been cut off.
    """
    pieces = fragments(spark, path, "}", glob).join(_range_states(spark, path, glob), _RANGE)
    # a join by broadcast keeps the order, any other doesn't
    pieces = pieces.sortWithinPartitions(*_RANGE, "place").select(*_RANGE, "value", "inside", "depth", "before")
    cut_out = pieces.mapInArrow(_cut_out, _PIECES)
    whole = cut_out.where("begun AND ended").select("file_path", "pos", "text", F.lit(True).alias("ended"))
    joined = (
        cut_out.where("NOT (begun AND ended)").groupBy("file_path", "pos")
        .agg(F.array_sort(F.collect_list(F.struct("range_start", "text"))).alias("parts"), F.bool_or("ended").alias("ended"))
        .select("file_path", "pos", F.array_join("parts.text", "").alias("text"), "ended")
    )
    first = F.col("pos") == 0
    before = F.when(first, F.regexp_like("text", F.lit(_FIRST))).otherwise(F.regexp_like("text", F.lit(_LATER)))
    rest = F.regexp_like("text", F.lit(_REST)) & ~first | F.regexp_like("text", F.lit(_EMPTY)) & first
    element = F.regexp_replace("text", r"^\s*[\[,]\s*(?=\{)", "")
    return whole.unionByName(joined).select(
        "file_path", "pos", F.when(F.col("ended"), element).alias("element"),
        F.when(F.col("ended"), before).otherwise(rest).alias("fits"),
    )


def file_texts(spark: SparkSession, path: str | Sequence[str], files: DataFrame, glob: str | None = None) -> DataFrame:
    """``(file_path, raw)`` of the files whose ``file_path`` is among ``files``."""
    pieces = fragments(spark, path, "}", glob).join(files, "file_path", "left_semi")
    ordered = F.array_sort(F.collect_list(F.struct("range_start", "place", "value")))
    whole = pieces.groupBy("file_path").agg(F.array_join(ordered["value"], "}").alias("raw"), F.max("size").alias("size"))
    closed = F.when(F.octet_length("raw") < F.col("size"), F.concat("raw", F.lit("}"))).otherwise(F.col("raw"))
    return whole.select("file_path", closed.alias("raw"))


def fragments(spark: SparkSession, path: str | Sequence[str], separator: str, glob: str | None = None) -> DataFrame:
    """``(file_path, range_start, place, value, size)``: the text between two separators, in order of ``place`` in a range."""
    reader = spark.read.option("lineSep", separator)
    if glob:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    raw = reader.text([path] if isinstance(path, str) else list(path))
    return raw.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("range_start"),
        F.monotonically_increasing_id().alias("place"), "value", F.col("_metadata.file_size").alias("size"),
    )


def _range_states(spark: SparkSession, path: str | Sequence[str], glob: str | None) -> DataFrame:
    """``(file_path, range_start, inside, depth, before)``: how each range begins, and the elements that ended before it.

    One small row a range; the prefix sums are over the ranges of a file.
    """
    totals = fragments(spark, path, "}", glob).select(*_RANGE, "value").mapInArrow(_totals, _TOTALS)
    earlier = Window.partitionBy("file_path").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)

    def so_far(value):
        return F.coalesce(F.sum(value).over(earlier), F.lit(0))

    inside = totals.withColumn("inside", (so_far(F.col("flips")) % 2).cast("int"))
    depth = inside.withColumn("depth", so_far(F.get("turned", "inside")))
    here = F.filter("ends", lambda e: (e["inside"] == F.col("inside")) & (e["depth"] + F.col("depth") == 1))
    counted = depth.withColumn("n", F.coalesce(F.get(here, F.lit(0))["n"], F.lit(0)))
    return counted.select(*_RANGE, "inside", "depth", so_far(F.col("n")).alias("before"))


def _steps(text: str) -> tuple[int, tuple[int, int]]:
    """Whether a piece leaves a string state other than it came in with; the depth it adds, by that state (outside, inside)."""
    plain = _ESCAPED.sub("", text) if "\\" in text else text
    parts = plain.split('"')
    outside, inside = ("".join(parts[first::2]) for first in (0, 1))
    added = [p.count("{") + p.count("[") - p.count("]") for p in (outside, inside)]
    return (len(parts) - 1) % 2, (added[0], added[1])


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range, from either string state: whether it turns, the depth it adds, the depths at which objects end."""
    now, state, depth, ends = None, [0, 1], [0, 0], Counter()

    def out() -> pa.RecordBatch:
        rows = [{"inside": s, "depth": d, "n": n} for (s, d), n in ends.items()]
        kind = pa.list_(pa.struct([("inside", pa.int32()), ("depth", pa.int64()), ("n", pa.int64())]))
        return pa.RecordBatch.from_arrays([
            pa.array([now[0]], pa.string()), pa.array([now[1]], pa.int64()), pa.array([state[0]], pa.int32()),
            pa.array([depth], pa.list_(pa.int64())), pa.array([rows], kind),
        ], names=["file_path", "range_start", "flips", "turned", "ends"])

    for batch in batches:
        for *key, text in zip(*(batch.column(c).to_pylist() for c in (*_RANGE, "value")), strict=True):
            if key != now:
                if now is not None:
                    yield out()
                now, state, depth, ends = key, [0, 1], [0, 0], Counter()
            flips, added = _steps(text)
            for start in (0, 1):
                depth[start] += added[state[start]]
                state[start] ^= flips
                if not state[start]:
                    depth[start] -= 1
                    ends[start, depth[start]] += 1
    if now is not None:
        yield out()


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements of the ranges whose start is known; ``begun`` and ``ended`` tell whether they do so in the range."""
    rows: list[tuple] = []
    now, held, begun, inside, depth, pos = None, [], False, 0, 0, 0

    def out() -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
        columns = list(zip(*rows, strict=True))
        rows.clear()
        names = ["file_path", "range_start", "pos", "begun", "ended", "text"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        for *key, text, state, level, before in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            if key != now:
                if held:
                    rows.append((*now, pos, begun, False, "".join(held)))
                # a range that isn't the first may begin within an element
                now, held, begun, inside, depth, pos = key, [], key[1] == 0, state, level, before
            flips, added = _steps(text)
            depth += added[inside]
            inside ^= flips
            held += (text, "}")
            if not inside:
                depth -= 1
                if depth == 1:
                    rows.append((*key, pos, begun, True, "".join(held)))
                    pos, held, begun = pos + 1, [], True
        if len(rows) >= 4096:
            yield out()
    if held:
        rows.append((*now, pos, begun, False, "".join(held)))
    if rows:
        yield out()
