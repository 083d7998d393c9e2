"""Directly addressable codes for token ids: byte chunks by level, continuation bitmaps, ranks.

Level 0 holds the low byte of every id; an id that needs more has its bit set in the level's
bitmap and its next byte in level 1, at the place that the rank of that bit names, and so on. The
rank directory counts the set bits before every block of 512, so any id is found with one rank a
level and no decoding of what lies before it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BLOCK = 512


@dataclass
class Level:
    chunks: np.ndarray
    bitmap: np.ndarray
    ranks: np.ndarray


def encode(ids: np.ndarray) -> list[Level]:
    levels, rest = [], ids.astype(np.uint32)
    while True:
        higher = rest >> np.uint32(8)
        more = higher > 0
        counts = np.add.reduceat(more, np.arange(0, len(more), _BLOCK)) if len(more) else np.empty(0, np.int64)
        ranks = np.append(0, np.cumsum(counts))[:-1].astype("<u4")
        levels.append(Level(rest.astype(np.uint8), np.packbits(more, bitorder="little"), ranks))
        rest = higher[more]
        if not len(rest):
            return levels


def access(levels: list[Level], i: int) -> int:
    """The id at position ``i``, reading one chunk and at most one block of bits a level."""
    value = 0
    for depth, level in enumerate(levels):
        value |= int(level.chunks[i]) << (8 * depth)
        if not level.bitmap[i >> 3] >> (i & 7) & 1:
            break
        start = i // _BLOCK * _BLOCK
        before = np.unpackbits(level.bitmap[start >> 3 : (i >> 3) + 1], bitorder="little")[: i - start]
        i = int(level.ranks[i // _BLOCK]) + int(before.sum())
    return value


def decode(levels: list[Level]) -> np.ndarray:
    """All ids, from the last level up."""
    values = np.empty(0, np.uint32)
    for level in reversed(levels):
        ids = level.chunks.astype(np.uint32)
        more = np.unpackbits(level.bitmap, count=len(ids), bitorder="little").astype(bool)
        ids[more] |= values << np.uint32(8)
        values = ids
    return values


def packed(levels: list[Level]) -> list[dict[str, bytes]]:
    return [{"chunks": x.chunks.tobytes(), "bitmap": x.bitmap.tobytes(), "ranks": x.ranks.tobytes()} for x in levels]


def unpacked(rows: list[dict[str, bytes]]) -> list[Level]:
    return [
        Level(np.frombuffer(x["chunks"], np.uint8), np.frombuffer(x["bitmap"], np.uint8), np.frombuffer(x["ranks"], "<u4"))
        for x in rows
    ]
