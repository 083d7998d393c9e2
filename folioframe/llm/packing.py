"""Order-preserving packing of documents into sequences by dynamic programming."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm.wordids import WordIds
from folioframe.llm.words import byte_column, in_batches

#: Cost of a cut inside a document, in tokens of padding: after a sentence, and elsewhere.
SENTENCE_CUT, OTHER_CUT = 8, 96
#: Where no sentence ends for so many tokens, a cut is allowed.
_GRID = 64
_PIECE = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])


def cheapest_cuts(places: list[int], costs: list[int], width: int) -> list[int]:
    """Indices of the places where an order-preserving packing of least cost is cut.

    ``places`` ascend from 0 and neighbours are at most ``width`` apart; the first and the last
    are always cut. A sequence costs its padding up to ``width``, a cut its own cost. The best
    packing up to a place extends the best one up to an earlier place inside the window of
    ``width``; the least of ``best + place`` over that sliding window is the head of a monotone
    queue, so the work is linear in the places.
    """
    best, back = [0] * len(places), [0] * len(places)
    keys = [0] * len(places)
    queue = deque([0])
    for j in range(1, len(places)):
        place = places[j]
        while places[queue[0]] < place - width:
            queue.popleft()
        back[j] = queue[0]
        best[j] = keys[queue[0]] + width - place + costs[j]
        keys[j] = key = best[j] + place
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(places) - 1
    while j:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def cut_places(ids: np.ndarray, ends: np.ndarray, grid: int = _GRID) -> tuple[np.ndarray, np.ndarray]:
    """Places and costs of the allowed cuts of one document, its end included.

    ``ends`` marks by id the tokens that end a sentence. Neighbours are at most ``grid`` apart.
    """
    n = len(ids)
    places = np.flatnonzero(ends[ids]) + 1
    places = np.append(places[places < n], n)
    gaps = np.diff(places, prepend=0)
    wide = np.flatnonzero(gaps > grid)
    if not len(wide):
        costs = np.full(len(places), SENTENCE_CUT)
        costs[-1] = 0
        return places, costs
    extra = np.concatenate([np.arange(places[i] - gaps[i] + grid, places[i], grid) for i in wide])
    every = np.append(places, extra)
    costs = np.append(np.full(len(places), SENTENCE_CUT), np.full(len(extra), OTHER_CUT))
    costs[len(places) - 1] = 0
    order = np.argsort(every, kind="stable")
    return every[order], costs[order]


def sentence_ends(words: WordIds, size: int) -> np.ndarray:
    """By token id, whether the token closes a sentence: it ends in a full stop, ``!`` or ``?``."""
    marks = np.zeros(size, bool)
    for token, i in words.tokenizer.get_vocab(with_added_tokens=False).items():
        marks[i] = token.removesuffix("</w>")[-1:] in (".", "!", "?")
    return marks


class Packer:
    """Packs a stream of documents, holding about ``horizon`` tokens at a time.

    When the horizon is full, the cheapest cuts of what is held are taken; all sequences but the
    last few are final and given out, the tail is planned again with what follows.
    """

    def __init__(self, width: int, ends: np.ndarray, first_sequence: int, horizon: int = 1 << 19, tail: int = 8):
        self.width, self.ends, self.sequence = width, ends, first_sequence
        self.horizon, self.tail = horizon, tail
        self.documents: deque[tuple] = deque()  # (doc_id, ids bytes, doc_tokens, first token held, places, costs)
        self.n = 0

    def add(self, doc_id: int | None, data: bytes) -> Iterator[tuple]:
        ids = np.frombuffer(data, "<u4")
        places, costs = cut_places(ids, self.ends, min(_GRID, self.width))
        self.documents.append((doc_id, data, len(ids), 0, places, costs))
        self.n += len(ids)
        if self.n >= self.horizon:
            yield from self._cut(self.tail)

    def finish(self) -> Iterator[tuple]:
        if self.documents:
            yield from self._cut(0)

    def _cut(self, tail: int) -> Iterator[tuple]:
        places, costs, at = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 0
        for _, _, size, first, spots, price in self.documents:
            places.append(spots - first + at)
            costs.append(price)
            at += size - first
        where = np.concatenate(places).tolist()
        cuts = cheapest_cuts(where, np.concatenate(costs).tolist(), self.width)
        final = cuts[: len(cuts) - tail] if tail else cuts
        begin = 0
        for cut in final:
            yield from self._sequence(where[cut] - begin)
            begin = where[cut]
        self.n -= begin

    def _sequence(self, length: int) -> Iterator[tuple]:
        offset = 0
        while offset < length:
            doc_id, data, size, first, spots, price = self.documents.popleft()
            take = min(size - first, length - offset)
            crc = zlib.crc32(memoryview(data)[4 * first : 4 * (first + take)])
            yield doc_id, first, take, crc, size, self.sequence, offset
            offset += take
            if first + take < size:
                used = bisect_right(spots, first + take)
                self.documents.appendleft((doc_id, data, size, first + take, spots[used:], price[used:]))
        self.sequence += 1


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, width: int = 2048, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces of documents laid gapless into sequences of at most ``width`` tokens.

    Documents keep their ``doc_id`` order: they are range-partitioned and sorted by it, and each
    partition is packed as a stream. A sequence ends at a document's end, after a sentence, or,
    where no sentence ends, at a multiple of 64 tokens; the cuts minimise padding plus a
    penalty for each cut inside a document. Only a partition's last sequence is short for want
    of text.

    Result: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``; sequence ids
    ascend with the order and leave gaps between partitions. A document's ids are those of the
    tokenizer without special tokens, then ``end_id``, so an empty or null text is one token.
    Null ids come first; rows that repeat an id are separate documents, ordered by text. An
    empty table gives no rows; other columns are ignored.
    """
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer)
        ends = sentence_ends(words, max(words.tokenizer.get_vocab_size(), end_id + 1))
        packer = Packer(width, ends, TaskContext.get().partitionId() << 32)
        end = np.array([end_id], dtype="<u4").tobytes()

        def pieces() -> Iterator[tuple]:
            for batch in batches:
                for one, data in zip(batch.column("doc_id").to_pylist(), byte_column(batch, "text"), strict=True):
                    yield from packer.add(one, words(data.decode("utf-8", "replace")) + end)
            yield from packer.finish()

        yield from in_batches(pieces(), _PIECE)

    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(
        run, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    )
