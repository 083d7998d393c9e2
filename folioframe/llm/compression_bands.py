"""Quality rules by compression: zstandard ratios of documents and chunks inside length-specific bands."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm.words import byte_column, gram_hashes, in_batches

#: Lowest and highest ratio of bytes to compressed bytes, by least length of a text in bytes. Each low
#: limit is above what random letters and digits reach in its class, with or without blanks.
BANDS = (
    (0, 0.0, 2.9), (512, 1.32, 3.2), (768, 1.34, 3.2), (1_024, 1.36, 3.2), (1_536, 1.38, 3.2), (2_048, 1.42, 3.9),
    (8_192, 1.5, 5.0), (65_536, 1.55, 6.5),
)
#: Lowest ratio of texts below SHORT bytes, by least length, when they are compressed after PROSE:
#: by themselves they hardly compress. Below 32 bytes nothing tells noise from names and numbers.
#: Texts of which most bytes are not ASCII have letters that PROSE has not, and no low limit below
#: SHORT; up to CHUNK bytes theirs is FOREIGN_LOW, as some scripts compress less than Latin letters.
FOREIGN_LOW = 1.3
SHORT, SHORT_LOWS = 512, ((0, 0.0), (32, 1.18), (64, 1.16), (128, 1.18), (192, 1.2), (256, 1.24), (384, 1.27))
PROSE = (
    "It was late in the year when the two of them came down to the river, and no one in the village could say where they had been. "
    "Les enfants jouaient devant la maison pendant que leur mère préparait le repas du soir. "
    "Der alte Mann ging langsam über die Brücke und sah den Schiffen nach, die zum Meer fuhren. "
    "La ciudad estaba tranquila y los niños volvían de la escuela con sus libros. "
).encode()
#: The band of chunks of CHUNK bytes, and the share of a text's chunks that may lie outside. The last
#: chunk ends with the text, and a shorter text is one chunk, in the band for its length.
CHUNK, CHUNK_BAND, CHUNK_SHARE = 2_048, (1.38, 3.6), 0.25

_SYMBOLS = b"#*$%&|<>"
_WHITE = b" \t\n\v\f\r"
_CONTINUED = bytes(range(0x80, 0xC0))
_ASCII = bytes(range(0x80))
_RULES = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
    ("ratio", pa.float64()), ("chunks_outside", pa.int64()), ("n_chunks", pa.int64()),
])


def repeated_window_words(words: list[bytes], width: int = 5) -> int:
    """Number of words inside windows of ``width`` words that occur twice or more in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    codes = np.fromiter(map(seen.setdefault, words, range(len(words))), np.int64, len(words))
    hashes = gram_hashes(codes.view(np.uint64) + np.uint64(1), width)
    order = np.sort(hashes)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    # equal windows have equal hashes, so only the windows found twice by hash are compared
    starts = np.flatnonzero(np.isin(hashes, twice))
    windows = codes[starts[:, None] + np.arange(width)]
    _, place, counts = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    starts = starts[counts[place.reshape(-1)] > 1]
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + width, -1)
    return int((np.cumsum(marks) > 0).sum())


def base_rule(words: list[bytes]) -> tuple[int, bool]:
    """Words in repeated windows, and whether the text fails the base rule."""
    repeats = repeated_window_words(words)
    return repeats, len(words) < 10 or 100 * repeats > 20 * len(words)


def duplicate_lines(data: bytes) -> int:
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


def in_band(size: int, ratio: float, foreign: bool = False) -> bool:
    low, high = next((low, high) for least, low, high in reversed(BANDS) if size >= least)
    return (min(low, FOREIGN_LOW) if foreign and size < CHUNK else low) <= ratio <= high


class Bands:
    """The compression verdict on one text: its ratio, and its chunks outside their band."""

    def __init__(self, level: int = 3):
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=False).compress
        self.prose_size = len(self.compress(PROSE))

    def noisy(self, data: bytes) -> bool:
        """Whether a text below SHORT bytes compresses less after PROSE than words do."""
        low = next(low for least, low in reversed(SHORT_LOWS) if len(data) >= least)
        return low > 0 and len(data) < low * (len(self.compress(PROSE + data)) - self.prose_size)

    def __call__(self, data: bytes) -> tuple[bool, float, int, int]:
        size = len(data)
        ratio = size / len(self.compress(data))
        foreign = size < CHUNK and 2 * len(data.translate(None, _ASCII)) > size
        good = in_band(size, ratio, foreign) and (size >= SHORT or foreign or not self.noisy(data))
        if size < CHUNK:
            return good, ratio, int(size > 0 and not good), int(size > 0)
        starts = [*range(0, size - CHUNK + 1, CHUNK), *([size - CHUNK] if size % CHUNK else [])]
        ratios = [CHUNK / len(self.compress(data[i : i + CHUNK])) for i in starts]
        outside = sum(not CHUNK_BAND[0] <= one <= CHUNK_BAND[1] for one in ratios)
        return good and outside <= CHUNK_SHARE * len(starts), ratio, outside, len(starts)


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Base counts and the compression verdict, one row for every row of ``docs``.

    A text is kept when it passes the base rule (ten words or more, at most a fifth of them in
    repeated five-word windows), its zstandard ratio lies in the band for its length, and at most
    a quarter of its 2,048-byte chunks lie outside the chunk band; the last chunk ends with the text.
    Texts below 512 bytes are compressed after fixed prose for the low limit. Too high a ratio means
    repetition, too low one means noise. A null text has no words and fails the base rule.
    Columns: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept``, then ``ratio, chunks_outside, n_chunks``. Repeated rows are judged each, and other
    columns are ignored.
    """
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands()

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for one, data in zip(batch.column("doc_id").to_pylist(), byte_column(batch, "text"), strict=True):
                    words = data.split()
                    repeats, failed = base_rule(words)
                    good, ratio, outside, n_chunks = bands(data)
                    yield (
                        one, len(words), len(data.translate(None, _WHITE + _CONTINUED)),
                        len(data) - len(data.translate(None, _SYMBOLS)), duplicate_lines(data), repeats,
                        failed, not failed and good, ratio, outside, n_chunks,
                    )

        yield from in_batches(rows(), _RULES)

    return source.mapInArrow(run, (
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "base_failed boolean, kept boolean, ratio double, chunks_outside bigint, n_chunks bigint"
    ))


def keep_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns and without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands()
        for batch in batches:
            kept = [not base_rule(data.split())[1] and bands(data)[0] for data in byte_column(batch, text)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
