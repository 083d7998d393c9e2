"""Words, word hashes and n-gram hashes of one text, inside Python tasks.

A word is a run of bytes other than space and ``\\x09``-``\\x0D``, which is how ``bytes.split``
cuts. Hashes have 64 bits; a word sequence is taken as equal to another when its hash is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def lower_ascii(data: bytes) -> bytes:
    return data.translate(_LOWER)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every output bit depends on every input bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * _MIX[0]
    values = values ^ (values >> np.uint64(27))
    values = values * _MIX[1]
    return values ^ (values >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words, by its first word; empty for fewer words.

    Powers of the multiplier make it a polynomial of the word hashes, so that two half-length
    runs give a run of double length and the cost grows with log ``k``.
    """
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total, done = np.zeros(n, np.uint64), 0
    block, size = hashes, 1
    while done < k:
        if k & size:
            total = total * _power(size) + block[done : done + n]
            done += size
        if done < k:
            block = block[: len(block) - size] * _power(size) + block[size:]
            size *= 2
    return mixed(total + np.uint64(k))


def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(int(_MULTIPLIER), exponent, 1 << 64))


def byte_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a text column; null counts as empty."""
    return [value or b"" for value in batch.column(name).cast(pa.binary()).to_pylist()]


def byte_rows(batches: Iterator[pa.RecordBatch], key: str, text: str) -> Iterator[tuple[object, bytes]]:
    for batch in batches:
        yield from zip(batch.column(key).to_pylist(), byte_column(batch, text), strict=True)


def in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows from a stream of row tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, schema, strict=True)], schema=schema
    )
