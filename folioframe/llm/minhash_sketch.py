"""Shingle sets and one-permutation sketches of one text, inside Python tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from folioframe.llm.words import gram_hashes, mixed, word_hashes


def shingle_set(words: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; a shorter text is one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    grams = np.sort(gram_hashes(word_hashes(words), min(k, len(words))))
    return grams[np.append(True, grams[1:] != grams[:-1])]


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


class Sketcher:
    """One-permutation hashing: one hash a shingle, ``bins`` minima, empty bins densified.

    The top bits of a shingle's hash name its bin. An empty bin takes the value of the first
    non-empty bin in its own random sequence of bins (optimal densification), so bins that two
    sets fill alike agree with probability equal to their similarity.
    """

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        width = int(np.ceil(np.log2(self.bins)))
        if 1 << width != self.bins:
            raise ValueError("bands * rows has to be a power of two")
        self.starts = np.arange(self.bins, dtype=np.uint64) << np.uint64(64 - width)
        self.salts = mixed(np.arange(1, bands + 1, dtype=np.uint64))

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row of bin minima a set; the sets must not be empty."""
        values = np.zeros((len(sets), self.bins), np.uint64)
        full = np.zeros((len(sets), self.bins), bool)
        for row, shingles in enumerate(sets):
            first = np.searchsorted(shingles, self.starts)
            full[row] = first < np.append(first[1:], len(shingles))
            values[row] = shingles[np.minimum(first, len(shingles) - 1)]
        rows, attempt, drawn = np.flatnonzero(~full.all(axis=1)), 0, full.copy()
        while len(rows):
            attempt += 1
            donors = self._donors(attempt)
            found = ~drawn[rows] & full[rows][:, donors]
            part = values[rows]
            values[rows] = np.where(found, part[:, donors], part)
            drawn[rows] |= found
            rows = rows[~drawn[rows].all(axis=1)]
        return values

    def _donors(self, attempt: int) -> np.ndarray:
        draws = mixed(np.arange(self.bins, dtype=np.uint64) + np.uint64(attempt * self.bins))
        return (draws % np.uint64(self.bins)).astype(np.int64)

    def band_keys(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of 64-bit bucket keys a set, one a band; keys of different bands differ."""
        grid = self.signatures(sets).reshape(len(sets), self.bands, self.rows)
        keys = np.broadcast_to(self.salts, (len(sets), self.bands))
        for column in range(self.rows):
            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + grid[:, :, column])
        return keys.view(np.int64)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets without repeats."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not len(short):
        return 0
    at = np.searchsorted(long, short)
    return int((long[np.minimum(at, len(long) - 1)] == short).sum())
