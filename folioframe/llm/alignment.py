"""Alignment of two tokenizers: groups of overlapping tokens by pointer jumping, links and their counts."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm.token_counts import split_is_safe
from folioframe.session import cut, discard

_BLANK = "▁"
#: A blank after which both tokenizers begin a new token, with it, whatever stands around.
_SAFE = re.compile(rf"(?<=[^\s{_BLANK}]) (?=[^\s{_BLANK}])")
_BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")

_ROW = pa.schema([
    ("block", pa.string()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("chunks", pa.binary()), ("pairs", pa.list_(pa.int64())),
    ("uses", pa.list_(pa.int64())), ("sizes", pa.binary()), ("links", pa.binary()),
])
_ROW_SQL = (
    "block string, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "chunks binary, pairs array<bigint>, uses array<bigint>, sizes binary, links binary"
)


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself where it can be seen, else one from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    unseen = sorted(set(range(256)) - set(seen))
    return {chr(b): b for b in seen} | {chr(0x100 + i): b for i, b in enumerate(unseen)}


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For each token, first those of A, then those of B, the B token that ends its group.

    Both are the end offsets of tokens that cut the same bytes without gaps. Every token points to
    the farthest-right token that overlaps it: the other side's token over its last byte. Only a B
    token that ends where an A token does points to itself. Successors are doubled until nothing
    moves, so steps grow with the logarithm of the longest group.
    """
    n_a = len(ends_a)
    over_b = np.searchsorted(ends_b, ends_a)
    over_a = np.searchsorted(ends_a, ends_b)
    last = ends_a[over_a] == ends_b if n_a else np.zeros(0, bool)
    pointer = np.concatenate([n_a + over_b, np.where(last, n_a + np.arange(len(ends_b)), over_a)])
    while True:
        jumped = pointer[pointer]
        if np.array_equal(jumped, pointer):
            return pointer
        pointer = jumped


class Aligner:
    """Tokens of both tokenizers over the same bytes, with the groups of a chunk kept by its text."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        visible = byte_letters()
        size = self.a.get_vocab_size()
        shown = [self.a.id_to_token(i) or "" for i in range(size)]
        self.bytes_a = [bytes(map(visible.__getitem__, t)) if set(t) <= visible.keys() else t.encode() for t in shown]
        self.bytes_b = [_piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.lengths_a = np.array(list(map(len, self.bytes_a)), np.int64)
        self.lengths_b = np.array(list(map(len, self.bytes_b)), np.int64)
        # an id as it is written before a token of its own side and before what follows then
        self.shown_a = np.array([f"{i},".encode() for i in range(size)] + [f"{i}|".encode() for i in range(size)], object)
        size_b = len(self.bytes_b)
        self.shown_b = np.array([f"{i},".encode() for i in range(size_b)] + [f"{i};".encode() for i in range(size_b)], object)
        self.splits = split_is_safe(self.b)
        self.forget()

    def forget(self) -> None:
        """Begin a block: no chunk is known."""
        self.known: dict[str, int] = {}
        self.odd: set[str] = set()
        self.texts: list[bytes | None] = []
        #: Tokens of A, tokens of B and groups of each chunk; the pairs of all chunks in order.
        self.sizes = np.zeros((3, 0), np.int64)
        self.pairs: list[np.ndarray] = []

    def chunks(self, text: str) -> list[str]:
        return _SAFE.split(text) if self.splits else [text]

    def learn(self, fresh: list[str]) -> None:
        """Align chunks not met before in this block."""
        ids_a = [e.ids for e in self.a.encode_batch_fast([" " + c for c in fresh], add_special_tokens=False)]
        ids_b = self.b.encode(fresh, num_threads=1)
        good = self._whole(fresh, ids_a, ids_b)
        if not all(good):
            self.odd.update(c for c, ok in zip(fresh, good, strict=True) if not ok)
            ids_a = [x if ok else [] for x, ok in zip(ids_a, good, strict=True)]
            ids_b = [x if ok else [] for x, ok in zip(ids_b, good, strict=True)]
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (ids_a, ids_b))
        flat_a = np.fromiter(chain.from_iterable(ids_a), np.int64, n_a.sum())
        flat_b = np.fromiter(chain.from_iterable(ids_b), np.int64, n_b.sum())
        ends = terminals(np.cumsum(self.lengths_a[flat_a]), np.cumsum(self.lengths_b[flat_b])) - len(flat_a)
        is_last = ends[len(flat_a) :] == np.arange(len(flat_b))
        label = np.cumsum(is_last) - is_last  # the number of a B token's group, from 0
        group_a, group_b = label[ends[: len(flat_a)]], label[ends[len(flat_a) :]]
        ends_a = np.append(group_a[1:] != group_a[:-1], True)[: len(flat_a)]
        self.pairs.append((flat_a[ends_a] << 32) | flat_b[is_last])
        # A tokens of a group, then its B tokens
        written = np.empty(len(flat_a) + len(flat_b), object)
        before_b = np.append(0, np.flatnonzero(is_last) + 1)
        after_a = np.flatnonzero(ends_a) + 1
        written[np.arange(len(flat_a)) + before_b[group_a]] = self.shown_a[flat_a + ends_a * (len(self.shown_a) // 2)]
        written[np.arange(len(flat_b)) + after_a[group_b]] = self.shown_b[flat_b + is_last * (len(self.shown_b) // 2)]
        edges = np.cumsum(n_a + n_b).tolist()
        begin = 0
        for chunk, end, ok in zip(fresh, edges, good, strict=True):
            self.known[chunk] = len(self.texts)
            self.texts.append(b"".join(written[begin:end]) if ok else None)
            begin = end
        groups = np.diff(np.append(0, np.cumsum(is_last))[np.append(0, np.cumsum(n_b))])
        self.sizes = np.concatenate([self.sizes, [n_a, n_b, groups]], axis=1)

    def _whole(self, fresh: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> list[bool]:
        """Whether the tokens of both sides give the bytes of a chunk after a blank."""
        data = [b" " + c.encode() for c in fresh]
        good = [True] * len(fresh)
        for ids, table in ((ids_a, self.bytes_a), (ids_b, self.bytes_b)):
            for i, one in enumerate(ids):
                if b"".join(map(table.__getitem__, one)) != data[i]:
                    good[i] = False
        return good


def _piece_bytes(piece: str) -> bytes:
    one = _BYTE_PIECE.fullmatch(piece)
    return bytes([int(one[1], 16)]) if one else piece.replace(_BLANK, " ").encode()


def align_tokenizers(
    docs: DataFrame, byte_level: str, pieces: str, block_chunks: int = 1 << 21, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` a row of ``docs``.

    ``byte_level`` is the path of a byte-level tokenizers file (A), ``pieces`` that of a
    sentencepiece model (B); every executor has both. A text, with a blank before it, is cut by both.
    Offsets where tokens of both end cut it into groups, and the two tokens that end there are a link.

    1. Texts fall into chunks at blanks where both tokenizers must begin a token. Each distinct chunk of
       a block of about ``block_chunks`` chunks is encoded and aligned once, many chunks at a time.
    2. A block gives its documents with the numbers of their chunks, and its distinct pairs with
       their uses. Pairs are summed over the blocks; each B id's highest count marks the best.
    3. Totals go back to the blocks that hold the pairs, and meet their documents there. So what
       moves is a block's distinct pairs, nothing is broadcast, and a group is a block.

    A text that is null or empty, or whose tokens don't give its bytes in either tokenizer, has no
    tokens: zeros and an empty ``groups_sha256``. Rows that repeat or lack an id are a row each.
    Other columns are ignored.
    """
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    blocks, block_path = cut(_blocks(source, byte_level, pieces, block_chunks), "blocks")
    held = blocks.where("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "uses")).alias("place", "p"))
    held = held.select("block", "place", F.col("p.pairs").alias("pair"), F.col("p.uses").alias("uses"))
    totals = held.groupBy("pair").agg(F.sum("uses").alias("total")).withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    totals, total_path = cut(totals, "totals")
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    judged = totals.join(highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    known = held.select("block", "place", "pair").join(judged, "pair").select(F.col("block").alias("of"), "place", "total", "best")
    left = blocks.select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "chunks", "sizes", "links")
    out, _ = cut(
        left.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(
            _counted, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
            "count_sum bigint, groups_sha256 string",
        ), "aligned",
    )
    discard(docs.sparkSession, block_path, total_path)
    return out


def _blocks(source: DataFrame, byte_level: str, pieces: str, block_chunks: int) -> DataFrame:
    """Rows of documents (with ``chunks``) and one row a block (with ``pairs``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        aligner, used, block = Aligner(byte_level, pieces), [], uuid.uuid4().hex
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield _documents(aligner, part, block, used)
                if sum(map(len, used)) >= block_chunks:
                    yield _dictionary(aligner, used, block)
                    aligner.forget()
                    used, block = [], uuid.uuid4().hex
        if used:
            yield _dictionary(aligner, used, block)

    return source.mapInArrow(run, _ROW_SQL)


def _documents(aligner: Aligner, part: pa.RecordBatch, block: str, used: list[np.ndarray]) -> pa.RecordBatch:
    parts = [aligner.chunks(t) if t else [] for t in part.column("text").to_pylist()]
    known = aligner.known
    fresh = list(dict.fromkeys(c for chunks in parts for c in chunks if c not in known))
    if fresh:
        aligner.learn(fresh)
    # a text with a chunk that doesn't come out byte for byte is judged as a whole
    odd = [" ".join(chunks) for chunks in parts if len(chunks) > 1 and not aligner.odd.isdisjoint(chunks)]
    odd = [text for text in dict.fromkeys(odd) if text not in known]
    if odd:
        aligner.learn(odd)
    rows = []
    for one, chunks in zip(part.column("doc_id").to_pylist(), parts, strict=True):
        places = np.fromiter(map(known.__getitem__, chunks), np.int32, len(chunks))
        texts = list(map(aligner.texts.__getitem__, places.tolist()))
        if len(texts) > 1 and None in texts:
            places = np.array([known[" ".join(chunks)]], np.int32)
            texts = [aligner.texts[places[0]]]
        if not texts or None in texts:
            rows.append((block, one, 0, 0, 0, 0, "", b""))
            continue
        n_a, n_b, n_groups = aligner.sizes[:, places].sum(axis=1).tolist()
        used.append(places)
        digest = hashlib.sha256(b"".join(texts)[:-1]).hexdigest()
        rows.append((block, one, n_a, n_b, n_groups, n_groups, digest, places.astype("<i4").tobytes()))
    columns = list(zip(*rows, strict=True))
    empty = [pa.nulls(len(rows), field.type) for field in _ROW][len(columns) :]
    arrays = [pa.array(c, field.type) for c, field in zip(columns, _ROW, strict=False)]
    return pa.RecordBatch.from_arrays([*arrays, *empty], schema=_ROW)


def _dictionary(aligner: Aligner, used: list[np.ndarray], block: str) -> pa.RecordBatch:
    """The row of a block: distinct pairs with their uses, and for each chunk the places of its links in them."""
    sizes = aligner.sizes[2]
    pairs, places = np.unique(np.concatenate([*aligner.pairs, np.empty(0, np.int64)]), return_inverse=True)
    times = np.zeros(len(sizes), np.int64)
    for one in used:
        times += np.bincount(one, minlength=len(sizes))
    uses = np.bincount(places, weights=np.repeat(times, sizes), minlength=len(pairs)).astype(np.int64)
    values = [block, None, None, None, None, None, None, None, pairs, uses,
              sizes.astype("<i4").tobytes(), places.astype("<i4").tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], field.type) for v, field in zip(values, _ROW, strict=True)], schema=_ROW)


def _counted(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of a block with the totals of its pairs."""
    documents, book = (left.filter(pc.is_valid(left.column(c))) for c in ("chunks", "sizes"))
    n_best = count_sum = np.zeros(documents.num_rows, np.int64)
    if book.num_rows:
        sizes = np.frombuffer(book.column("sizes")[0].as_py(), "<i4")
        links = np.frombuffer(book.column("links")[0].as_py(), "<i4")
        totals, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        at = right.column("place").to_numpy()
        totals[at], best[at] = right.column("total").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        by_chunk = [np.diff(np.concatenate([[0], np.cumsum(v[links])])[edges]) for v in (best, totals)]
        chunks = [np.frombuffer(c, "<i4") for c in documents.column("chunks").to_pylist()]
        ends = np.cumsum([0, *map(len, chunks)])
        flat = np.concatenate([*chunks, np.empty(0, "<i4")])
        n_best, count_sum = (np.diff(np.concatenate([[0], np.cumsum(v[flat])])[ends]) for v in by_chunk)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return pa.table({
        **{name: documents.column(name) for name in names}, "n_best": pa.array(n_best, pa.int64()),
        "count_sum": pa.array(count_sum, pa.int64()), "groups_sha256": documents.column("groups_sha256"),
    })
