"""Length of the longest common subsequence of two token sequences."""

from __future__ import annotations

from collections.abc import Hashable, Sequence


def lcs_length(a: Sequence[Hashable], b: Sequence[Hashable], width: int = 8192) -> int:
    """Bit-parallel LCS (Hyyro, 2004): one integer holds a row of the table.

    Tokens that only one side has cannot be part of it and are left out. The longer rest is
    taken in slices of ``width`` tokens, and what a row's addition carries out of one slice
    goes into the next. Memory is bounded by the slice, not by the text.
    """
    shared = set(a).intersection(b)
    a, b = [t for t in a if t in shared], [t for t in b if t in shared]
    longer, shorter = (a, b) if len(a) >= len(b) else (b, a)
    carry = bytearray(len(shorter))
    common = 0
    for start in range(0, len(longer), width):
        part = longer[start : start + width]
        where: dict[Hashable, int] = {}
        for i, token in enumerate(part):
            where[token] = where.get(token, 0) | (1 << i)
        full = (1 << len(part)) - 1
        row = full
        for j, token in enumerate(shorter):
            hits = row & where.get(token, 0)
            if hits or carry[j]:
                total = row + hits + carry[j]
                carry[j] = total >> len(part)
                row = (total | (row - hits)) & full
        common += len(part) - row.bit_count()
    return common
