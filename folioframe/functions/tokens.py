"""The ROUGE tokens of a batch of texts as arrays, inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from folioframe.functions.text import as_column

#: Bytes of text that are held as arrays at a time, unless one text is longer; grams hashed at a time.
PART_BYTES, _BLOCK = 1 << 22, 1 << 17
_IS_TOKEN = np.zeros(256, bool)
_IS_TOKEN[[*range(ord("a"), ord("z") + 1), *range(ord("0"), ord("9") + 1)]] = True
_BLANK = ord(" ")
# Any odd number with bits in all places, and its inverse modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


class Tokens(NamedTuple):
    """Tokens of some texts: ``data`` has a space after each; where each starts and ends there, and its text's number."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray


def closed_text(text: Column | str) -> Column:
    """Lower-case text with a line end, so that no token goes on in the next text; null is empty."""
    return F.concat(F.lower(F.coalesce(as_column(text), F.lit(""))), F.lit("\n"))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts without nulls, and where each begins."""
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def parts(*sides: pa.Array) -> Iterator[slice]:
    """Runs of rows whose texts have ``PART_BYTES`` in all, or one row."""
    if not len(sides[0]):
        return
    ends = sum(text_bytes(side)[1][1:] for side in sides)
    start = 0
    while start < len(ends):
        held = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, held + PART_BYTES, "right")))
        yield slice(start, stop)
        start = stop


def tokenize(texts: pa.Array) -> Tokens:
    """The tokens of closed texts."""
    raw, begins = text_bytes(texts)
    is_token = _IS_TOKEN[raw]
    after = np.zeros(len(raw), bool)
    after[1:] = is_token[:-1] & ~is_token[1:]
    stops = np.flatnonzero(after)
    data = np.where(is_token, raw, np.uint8(_BLANK))[is_token | after]
    ends = np.flatnonzero(data == _BLANK)
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(ends)]
    return Tokens(data, starts, ends, np.searchsorted(begins, stops, "right") - 1)


def word_codes(tokens: Tokens) -> tuple[np.ndarray, pa.Array]:
    """A number for each token, equal for equal ones, and the distinct tokens, each with a space after it."""
    offsets = np.append(tokens.starts, len(tokens.data)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(tokens.ends), pa.py_buffer(offsets), pa.py_buffer(tokens.data))
    coded = words.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def gram_places(tokens: Tokens, n: int) -> np.ndarray:
    """The tokens that ``n - 1`` tokens of the same text follow."""
    last = max(len(tokens.rows) - n + 1, 0)
    return np.flatnonzero(tokens.rows[:last] == tokens.rows[n - 1 :][:last])


def gram_texts(tokens: Tokens, places: np.ndarray, n: int) -> pa.Array:
    """The n-grams at some places, their tokens joined by a space."""
    starts, ends = tokens.starts[places], tokens.ends[places + (n - 1)]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    picked = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], ends - starts)
    held = pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(tokens.data[picked])
    return pa.LargeStringArray.from_buffers(len(places), *held)


def _powers(base: int, n: int) -> np.ndarray:
    values = np.full(n, base, np.uint64)
    values[:1] = 1
    return np.cumprod(values, dtype=np.uint64)


def gram_hashes(tokens: Tokens, places: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of places with 64-bit hashes of their n-grams, which depend on the n-gram's text alone."""
    for i in range(0, len(places), _BLOCK):
        block = places[i : i + _BLOCK]
        first = tokens.starts[block[0]]
        text = tokens.data[first : tokens.ends[block[-1] + (n - 1)]]
        upto = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(text * _powers(_BASE, len(text)), dtype=np.uint64, out=upto[1:])
        starts, ends = tokens.starts[block] - first, tokens.ends[block + (n - 1)] - first
        hashes = (upto[ends] - upto[starts]) * _powers(_BACK, len(text))[starts]
        hashes ^= hashes >> np.uint64(32)
        yield block, hashes * np.uint64(0xD6E8FEB86659FD93)
