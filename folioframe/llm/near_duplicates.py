"""MinHash near-duplicates: one-permutation sketches, banded buckets, star-shaped candidate edges."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.llm.components import connected_components
from folioframe.llm.crowds import crowd_links
from folioframe.llm.minhash_sketch import Sketcher, overlap, set_key, shingle_set
from folioframe.llm.words import byte_column, lower_ascii
from folioframe.session import cut, discard

_SKETCH = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()),
    ("buckets", pa.list_(pa.int64())),
])


def near_duplicates(
    docs: DataFrame, k: int = 5, percent: int = 80, bands: int = 32, rows: int = 4,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    A document's set are the distinct ``k``-word shingles of its text, ASCII-lowercased; a shorter
    text is one shingle. Two sets are linked when they share at least ``percent`` hundredths of
    their union; ``component_id`` is the smallest id reachable over links, and ``kept`` marks
    the document that has it. The links are found in these steps:

    1. Equal sets become one, so copies cost nothing further on.
    2. Every set is sketched by one-permutation hashing and dealt into one bucket a band.
    3. Each bucket links its members to one of them only: a star, not all pairs.
       Candidates are confirmed on the full sets, and links give components.
    4. A bucket whose members now share one component is done. In others two members that the
       centre does not link may still be alike. Such a bucket is cut into blocks of bounded
       size, and its sets meet by pairs of blocks (``crowd_links``). Every pair of unlike components is
       judged on the full sets there, and only links that join components come out: fewer rows
       than the block has members. No pair of a bucket is lost.

    A pair at the threshold misses every bucket with probability ``(1 - s**rows)**bands``, which
    is 4e-8 at the defaults.

    Ids are labels only. Rows without an id take part and can join others; their ``component_id`` is the
    smallest id of their group as well. In a group without any id it is null, and one row is kept.
    Rows that repeat an id are one node, linked whatever their texts. Null or wordless texts have no shingles
    and are linked with nothing: their own id is their component. Other columns are ignored.
    """
    source = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")
    )
    keyed, _ = cut(source, "texts")
    return _grouped(keyed, k, percent, bands, rows).select("doc_id", "n_shingles", "component_id", "kept")


def drop_near_duplicates(
    docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, one for each id and set; wordless rows without an id stay.

    Rows of one id and unlike texts are one node: all stay, or all go with a near-duplicate of a smaller id.
    """
    key = "row_" + "_".join(docs.columns)
    keyed, _ = cut(docs.withColumn(key, F.monotonically_increasing_id()), "texts")
    source = keyed.select(F.col(key).alias("row"), F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    kept = _grouped(source, k, percent, 32, 4).where("kept")
    named = kept.where("doc_id IS NOT NULL").groupBy("doc_id", "set_key").agg(F.min("row").alias(key)).select(key)
    stays = named.union(kept.where("doc_id IS NULL").select("row"))
    return keyed.join(stays, key, "left_semi").select(docs.columns)


def _grouped(source: DataFrame, k: int, percent: int, bands: int, rows: int) -> DataFrame:
    """``(row, doc_id, n_shingles, set_key, component_id, kept)`` for a written table ``(row, doc_id, text)``.

    Nodes are sets, named by the smallest ``row`` that has one.
    """
    spark = source.sparkSession
    sketches, _ = cut(_sketched(source, k, bands, rows), "sketches")
    worded = sketches.where("n_shingles > 0")
    sets = worded.groupBy("set_key").agg(
        F.min("row").alias("rep"), F.min("doc_id").alias("least_id"),
        F.first("n_shingles").alias("n_shingles"), F.first("buckets").alias("buckets"),
    )
    dealt = sets.select("rep", "n_shingles", F.explode("buckets").alias("bucket"))
    shared = (
        dealt.groupBy("bucket").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
        .where("a < b").select("bucket")
    )
    members, member_path = cut(dealt.join(shared, "bucket"), "members")
    wanted = members.select("rep").distinct()
    texts, text_path = cut(source.join(wanted, F.col("row") == F.col("rep")).select("rep", "text"), "texts")

    found, found_path = cut(_confirmed(_star_pairs(members, percent), texts, k, percent), "found")
    labels = connected_components(found.union(_id_links(worded)))
    rest, rest_path = cut(_unresolved(_without_centres(members), labels), "members")
    discard(spark, member_path)
    if not rest.isEmpty():
        more, more_path = cut(crowd_links(rest, texts, k, percent), "found")
        if not more.isEmpty():
            known = labels.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))
            labels = connected_components(known.union(more))
        discard(spark, more_path)
    discard(spark, text_path, found_path, rest_path)

    nodes = sets.select("set_key", "rep", "least_id").join(labels, F.col("rep") == F.col("node"), "left").select(
        "set_key", "rep", "least_id", F.coalesce("component", "rep").alias("component")
    )
    groups = nodes.groupBy("component").agg(F.min("least_id").alias("least"), F.min("rep").alias("first_row"))
    named = nodes.join(groups, "component").select("set_key", "least", "first_row")
    return sketches.join(named, "set_key", "left").select(
        "row", "doc_id", "n_shingles", "set_key",
        F.expr("CASE WHEN n_shingles = 0 THEN doc_id ELSE least END").alias("component_id"),
        F.expr(
            "CASE WHEN n_shingles = 0 THEN true WHEN least IS NULL THEN row = first_row ELSE doc_id <=> least END"
        ).alias("kept"),
    )


def _id_links(worded: DataFrame) -> DataFrame:
    """Links between the sets of rows that repeat an id."""
    several = (
        worded.where("doc_id IS NOT NULL").groupBy("doc_id")
        .agg(F.min("set_key").alias("a"), F.max("set_key").alias("b")).where("a < b").select("doc_id", F.col("a").alias("first_key"))
    )
    ends = worded.join(several, "doc_id").select("set_key", "first_key").distinct()
    reps = worded.groupBy("set_key").agg(F.min("row").alias("rep"))
    return (
        ends.join(reps.select("set_key", F.col("rep").alias("u")), "set_key")
        .join(reps.select(F.col("set_key").alias("first_key"), F.col("rep").alias("v")), "first_key")
        .select("u", "v")
    )


def _sketched(source: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(bands, rows)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sets = [shingle_set(lower_ascii(data).split(), k) for data in byte_column(part, "text")]
                full = [i for i, shingles in enumerate(sets) if len(shingles)]
                buckets: list = [[] for _ in sets]
                if full:
                    for i, keys in zip(full, sketcher.band_keys([sets[i] for i in full]), strict=True):
                        buckets[i] = keys
                yield pa.RecordBatch.from_arrays([
                    part.column("row"), part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) for s in sets], pa.binary()), pa.array(buckets, pa.list_(pa.int64())),
                ], schema=_SKETCH)

    return source.mapInArrow(run, "row bigint, doc_id bigint, n_shingles bigint, set_key binary, buckets array<bigint>")


def _star_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``(a, b)`` of a bucket's smallest member and its others."""
    first = members.groupBy("bucket").agg(F.min(F.struct("rep", "n_shingles")).alias("c"))
    centres = first.select("bucket", F.col("c.rep").alias("a"), F.col("c.n_shingles").alias("n_a"))
    pairs = members.join(centres, "bucket").where(F.col("rep") != F.col("a")).where(_alike_in_size("n_shingles", "n_a", percent))
    return pairs.select("a", F.col("rep").alias("b")).distinct()


def _alike_in_size(a: str, b: str, percent: int) -> Column:
    """Sets whose sizes differ by more can't be alike enough."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _without_centres(members: DataFrame) -> DataFrame:
    first = members.groupBy("bucket").agg(F.min("rep").alias("a"))
    return members.join(first, "bucket").where(F.col("rep") != F.col("a")).drop("a")


def _unresolved(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members ``(bucket, rep, n_shingles, label, weight)`` of buckets that hold two components or more.

    ``weight`` is the bucket's size in shingles, with an allowance a member.
    """
    fresh = members.join(labels, F.col("rep") == F.col("node"), "left").select(
        "bucket", "rep", "n_shingles", F.coalesce("component", "rep").alias("label")
    )
    several = (
        fresh.groupBy("bucket")
        .agg(F.min("label").alias("a"), F.max("label").alias("b"), F.sum(F.col("n_shingles") + 250).alias("weight"))
        .where("a < b").select("bucket", "weight")
    )
    return fresh.join(several, "bucket")


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` whose full sets are alike enough."""
    rows = (
        pairs.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_set = None, None
        for batch in batches:
            left, right, found = batch.column("a").to_pylist(), byte_column(batch, "text_b"), []
            for i, data in enumerate(byte_column(batch, "text_a")):
                if held != (left[i], data):
                    held, held_set = (left[i], data), shingle_set(lower_ascii(data).split(), k)
                other = shingle_set(lower_ascii(right[i]).split(), k)
                both = overlap(held_set, other)
                if both * 100 >= (len(held_set) + len(other) - both) * percent:
                    found.append(i)
            kept = batch.select(["a", "b"]).take(pa.array(found, pa.int64()))
            yield pa.RecordBatch.from_arrays(kept.columns, names=["u", "v"])

    return rows.mapInArrow(run, "u bigint, v bigint")
