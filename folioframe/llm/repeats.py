"""Substring dedup: winnowed anchors as seeds, extended both ways to windows and maximal repeats."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from folioframe.llm.words import byte_column, gram_hashes, in_batches, word_hashes
from folioframe.session import cut, discard

_SEEDS = pa.schema([
    ("doc_id", pa.int64()), ("copy_key", pa.int64()), ("n_words", pa.int64()), ("sha256", pa.string()),
    ("anchors", pa.list_(pa.struct([("hash", pa.int64()), ("pos", pa.int32())]))),
])
_SEEDS_SQL = "doc_id bigint, copy_key bigint, n_words bigint, sha256 string, anchors array<struct<hash: bigint, pos: int>>"
_WORD = re.compile(rb"[^ \t-\r]+")


def anchor_places(grams: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Winnowing: for every run of ``span`` k-gram hashes the place of its least, and the places.

    The first of equal hashes counts. A run's choice depends on the run alone, so equal runs
    anywhere choose the same k-gram.
    """
    if len(grams) < span:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    chosen = sliding_window_view(grams, span).argmin(axis=1) + np.arange(len(grams) - span + 1)
    return chosen, chosen[np.append(True, chosen[1:] != chosen[:-1])]


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``width`` words that begins at one of ``starts``."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + width, -1)
    return np.cumsum(marks)[:n] > 0


def repeated_passages(
    docs: DataFrame, width: int = 35, anchor_words: int = 8, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, spans)`` for every row of ``docs``.

    A word is removed when a window of ``width`` words covers it whose word sequence also begins
    somewhere else, in another document or the same. ``spans`` are the maximal removed runs
    ``(first, last)`` by word number from 0; ``kept_sha256`` is over the kept words joined by one
    blank.

    1. Seeds: every text is winnowed; of each run of ``width - anchor_words + 1`` hashes of
       ``anchor_words`` words the least is an anchor. A repeated window has the same anchor at
       every place, so windows whose anchor is unique in the corpus are done.
    2. Anchors found at two places or more are joined to the documents that hold them.
    3. Extension: each repeated anchor is extended both ways over the windows that chose it, up to
       ``width - anchor_words`` words either way, as one hash a window. Windows are counted
       by hash, not compared pair by pair, so a passage of a million copies costs a million rows
       and loses no partner that differs from the first.
    4. Repeated windows go back to their documents; windows that overlap join to maximal repeats.

    Texts of equal words are represented by the smallest id: each window of theirs is repeated.
    Shorter texts than ``width`` keep all words; null texts have none. Rows that repeat an id
    are one document each if their texts differ, and copies of each other if not; so are rows
    without an id. Other columns are ignored.
    """
    return _repeated(docs, width, anchor_words, doc_id, text).drop("copy_key")


def _repeated(docs: DataFrame, width: int, anchor_words: int, doc_id: str, text: str) -> DataFrame:
    """``repeated_passages`` with the ``copy_key`` of each row, which names its words."""
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    seeds, seed_path = cut(_seeded(source, width, anchor_words), "seeds")

    # rep is null where no row of the words has an id
    copies = seeds.groupBy("copy_key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies"))
    named = seeds.select("doc_id", "copy_key", "n_words", "sha256").join(copies, "copy_key")

    placed = seeds.select("doc_id", "copy_key", F.explode("anchors").alias("a")).select(
        "doc_id", "copy_key", F.col("a.hash").alias("hash"), F.col("a.pos").alias("pos")
    )
    # copies of a text have the same code for an anchor, so they don't make it repeated
    code = F.xxhash64("copy_key", "pos")
    twice = placed.groupBy("hash").agg(F.min(code).alias("a"), F.max(code).alias("b")).where("a < b").select("hash")
    repeated = placed.join(twice, "hash").groupBy("doc_id", "copy_key").agg(F.collect_set("pos").alias("anchors"))
    seeded = (
        repeated.join(copies, "copy_key").where("doc_id <=> rep")
        .select(F.col("doc_id").alias("seed_id"), F.col("copy_key").alias("seed_key"), "anchors")
    )
    # rows of one id have their own anchors by their words, and one row stands for rows of equal words
    keyed = _keyed(source, "text", "copy_key")
    named_texts = keyed.join(seeded, F.col("doc_id").eqNullSafe(F.col("seed_id")) & (F.col("copy_key") == F.col("seed_key")))
    texts, text_path = cut(named_texts.select("copy_key", "anchors", "text").dropDuplicates(["copy_key"]), "texts")
    windows, window_path = cut(_extended(texts, width, anchor_words), "windows")

    again = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    starts = windows.join(again, "window").groupBy("copy_key").agg(F.collect_list("start").alias("starts"))
    results, result_path = cut(_removed(texts.select("copy_key", "text").join(starts, "copy_key"), width), "removed")
    discard(spark, text_path, window_path)

    found = results.select(F.col("copy_key").alias("key"), "n_removed", "kept_sha256", "spans")
    whole = F.array(F.struct(F.lit(0).cast("int").alias("first"), (F.col("n_words") - 1).cast("int").alias("last")))
    none = F.array().cast("array<struct<first: int, last: int>>")
    copied = F.coalesce((F.col("n_copies") > 1) & (F.col("n_words") >= width), F.lit(False))
    return named.join(found, F.col("copy_key") == F.col("key"), "left").select(
        "doc_id", "copy_key", "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copied, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        F.when(copied, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
    )


def cut_repeated_passages(
    docs: DataFrame, width: int = 35, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars",
) -> DataFrame:
    """The rows of ``docs`` with the words of repeated passages cut from their texts.

    Texts without such words stay byte for byte; a text that loses all its words goes with its
    row. ``n_chars``, where the table has it, is counted anew for texts that changed.
    """
    found = _repeated(docs, width, 8, doc_id, text).where("n_removed > 0")
    spans = found.select(
        F.col("doc_id").alias("_cut_id"), F.col("copy_key").alias("_cut_key"), F.col("spans").alias("_spans"),
        (F.col("n_removed") == F.col("n_words")).alias("_emptied"),
    ).dropDuplicates(["_cut_id", "_cut_key"])
    keyed = _keyed(docs, text, "_words_key")
    same = keyed[doc_id].eqNullSafe(spans["_cut_id"]) & (keyed["_words_key"] == spans["_cut_key"])
    joined = keyed.join(spans, same, "left").where("_emptied IS NULL OR NOT _emptied")
    types = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, cuts = batch.column(text).to_pylist(), batch.column("_spans").to_pylist()
            changed = [i for i, one in enumerate(cuts) if one]
            for i in changed:
                texts[i] = cut_spans(texts[i], [(s["first"], s["last"]) for s in cuts[i]])
            batch = batch.drop_columns(["_spans"])
            batch = batch.set_column(batch.schema.get_field_index(text), text, pa.array(texts, pa.string()))
            if n_chars in types:
                place = batch.schema.get_field_index(n_chars)
                sizes = batch.column(place).to_pylist()
                for i in changed:
                    sizes[i] = len(texts[i])
                batch = batch.set_column(place, n_chars, pa.array(sizes, batch.schema.field(place).type))
            yield batch

    return joined.select(*docs.columns, "_spans").mapInArrow(run, docs.schema)


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans; what is between kept words stays as it is."""
    data = text.encode()
    places = [match.span() for match in _WORD.finditer(data)]
    kept, at = [], 0
    for first, last in spans:
        kept.append(data[at : places[first][0]])
        at = places[last + 1][0] if last + 1 < len(places) else len(data)
    kept.append(data[at:])
    return b"".join(kept).decode()


def words_key(plain: bytes) -> int:
    """Signed 64-bit key of the words of a text, joined by one blank."""
    key = xxhash.xxh3_64_intdigest(plain)
    return key - (1 << 64) if key >> 63 else key


def _keyed(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` with the key of each text's words as column ``name``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [words_key(b" ".join(data.split())) for data in byte_column(batch, text)]
            yield batch.append_column(name, pa.array(keys, pa.int64()))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def _seeded(source: DataFrame, width: int, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for one, data in zip(batch.column("doc_id").to_pylist(), byte_column(batch, "text"), strict=True):
                    words = data.split()
                    plain = b" ".join(words)
                    grams = gram_hashes(word_hashes(words), k) if len(words) >= width else np.empty(0, np.uint64)
                    _, places = anchor_places(grams, width - k + 1)
                    anchors = [{"hash": h, "pos": p} for h, p in zip(grams[places].view(np.int64).tolist(), places.tolist(), strict=True)]
                    yield one, words_key(plain), len(words), hashlib.sha256(plain).hexdigest(), anchors

        yield from in_batches(rows(), _SEEDS, 512)

    return source.mapInArrow(run, _SEEDS_SQL)


def _extended(texts: DataFrame, width: int, k: int) -> DataFrame:
    """``(window, copy_key, start)`` for the windows whose anchor is among ``anchors``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, anchors = (batch.column(c).to_pylist() for c in ("copy_key", "anchors"))
            for i, data in enumerate(byte_column(batch, "text")):
                hashes = word_hashes(data.split())
                chosen, _ = anchor_places(gram_hashes(hashes, k), width - k + 1)
                seeds = np.zeros(len(hashes) + 1, bool)
                seeds[anchors[i]] = True
                starts = np.flatnonzero(seeds[chosen])
                windows = gram_hashes(hashes, width)[starts]
                yield pa.RecordBatch.from_arrays([
                    pa.array(windows.view(np.int64)), pa.array(np.full(len(starts), keys[i], np.int64)), pa.array(starts.astype(np.int32)),
                ], names=["window", "copy_key", "start"])

    columns = texts.select("copy_key", "anchors", "text")
    return columns.mapInArrow(run, "window bigint, copy_key bigint, start int")


def _removed(rows: DataFrame, width: int) -> DataFrame:
    schema = pa.schema([
        ("copy_key", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
        ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for batch in batches:
                keys, starts = batch.column("copy_key").to_pylist(), batch.column("starts").to_pylist()
                for i, data in enumerate(byte_column(batch, "text")):
                    words = data.split()
                    gone = covered(np.array(starts[i], np.int64), width, len(words))
                    kept = b" ".join(word for word, out in zip(words, gone, strict=True) if not out)
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                    spans = [{"first": a, "last": b - 1} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
                    yield keys[i], int(gone.sum()), hashlib.sha256(kept).hexdigest(), spans

        yield from in_batches(out(), schema, 512)

    columns = rows.select("copy_key", "starts", "text")
    return columns.mapInArrow(
        run, "copy_key bigint, n_removed bigint, kept_sha256 string, spans array<struct<first: int, last: int>>"
    )
