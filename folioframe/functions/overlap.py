"""Clipped n-gram overlap and longest common subsequence of two texts: in Arrow batches, and n-grams as built-in expressions.

Counting n-grams by exploding and grouping would shuffle every text many times larger, although no
count ever crosses a pair. Here a pair stays one row. A batch's tokens are numbered once for both
sides, n-grams are numbers made of those, and counts are taken for many pairs at a time.

As expressions, an overlap clipped by counts is the number of shared distinct n-grams plus, for those that
both texts repeat, the shared second, third, ... occurrences. Repeats are read off the sorted
n-grams as runs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from folioframe.functions.lcs import lcs_length
from folioframe.functions.stemming import stem_codes
from folioframe.functions.text import as_column
from folioframe.functions.tokens import Tokens, closed_text, gram_places, parts, tokenize, word_codes

# An n-gram followed by at least one copy of itself, in sorted space-separated n-grams.
RUN = r"(?<![^ ])(\S++)(?: \1(?= |$))++"

#: Counts of single tokens as they are spelled.
PLAIN = ("plain_hits", "plain_ref", "plain_cand")


def overlap_of_texts(
    reference: Column | str, candidate: Column | str, sizes: Sequence[int], distinct: bool = False,
    longest: bool = False, stemmed: bool = False, plain: bool = False,
) -> Column:
    """A struct of ``hits_n, ref_n, cand_n`` for each size, ``lcs`` and ``PLAIN`` if asked for.

    Hits are clipped by counts or, with ``distinct``, of distinct n-grams; sizes count likewise. The ``lcs`` needs size 1.
    The ``PLAIN`` ones, which need size 1 too, are its counts without stems.
    """
    names = [f"{kind}_{n}" for n in sizes for kind in ("hits", "ref", "cand")] + ["lcs"] * longest + [*PLAIN] * plain
    known: dict[str, str] = {}

    def measure(ref: pa.Array, cand: pa.Array) -> pa.Array:
        out = {name: [np.empty(0, np.int64)] for name in names}
        for part in parts(ref, cand):
            tokens = tokenize(pa.concat_arrays([ref[part], cand[part]]))
            codes, words = word_codes(tokens)
            n_pairs, counts = part.stop - part.start, {}
            if stemmed:
                if plain:
                    counts = _plain(_counts(tokens, codes, n_pairs, (1,), distinct, False))
                codes = stem_codes(words, known)[codes]
            counts |= _counts(tokens, codes, n_pairs, sizes, distinct, longest)
            if plain and not stemmed:
                counts |= _plain(counts)
            for name, values in counts.items():
                out[name].append(values)
        return pa.StructArray.from_arrays([pa.array(np.concatenate(out[name]), pa.int64()) for name in names], names)

    measured = F.arrow_udf(measure, ", ".join(f"{name} bigint" for name in names))
    return measured(closed_text(as_column(reference)), closed_text(as_column(candidate)))


def _counts(tokens: Tokens, codes: np.ndarray, n_pairs: int, sizes: Sequence[int], distinct: bool, longest: bool) -> dict[str, np.ndarray]:
    """Counts of each pair; the references are the first ``n_pairs`` texts, the candidates the others."""
    out = {}
    for n in sizes:
        places = gram_places(tokens, n)
        rows, grams = tokens.rows[places], _gram_numbers(codes, n)[places]
        n_grams = int(grams.max(initial=0)) + 1
        in_pair = (rows % n_pairs) * n_grams + grams
        first = int(np.searchsorted(rows, n_pairs))
        known, own, n_own = np.unique(in_pair[:first], return_inverse=True, return_counts=True)
        asked = in_pair[first:]
        at = np.searchsorted(known, asked)
        met = known[np.minimum(at, len(known) - 1)] == asked if len(known) else np.zeros(len(asked), bool)
        n_met = np.bincount(at[met], minlength=len(known))
        shared = np.minimum(n_own, 1 if distinct else n_met) * (n_met > 0)
        out[f"hits_{n}"] = np.bincount(known // n_grams, shared, n_pairs).astype(np.int64)
        sides = [known, np.unique(asked)] if distinct else [in_pair[:first], asked]
        out[f"ref_{n}"], out[f"cand_{n}"] = (np.bincount(side // n_grams, minlength=n_pairs) for side in sides)
        if longest and n == 1:
            both = np.concatenate([n_met[own] > 0, met])
            held, upto = grams[both].tolist(), np.searchsorted(rows[both], np.arange(2 * n_pairs + 1)).tolist()
            texts = [held[a:b] for a, b in zip(upto, upto[1:])]
            out["lcs"] = np.array([lcs_length(a, b) for a, b in zip(texts, texts[n_pairs:])], np.int64)
    return out


def _plain(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return dict(zip(PLAIN, (counts[name] for name in ("hits_1", "ref_1", "cand_1")), strict=True))


def _gram_numbers(codes: np.ndarray, n: int) -> np.ndarray:
    """A number for the n-gram at every place, equal for equal ones."""
    n_codes, grams = int(codes.max(initial=0)) + 1, codes
    for i in range(1, n):
        if i > 1:
            grams = np.unique(grams, return_inverse=True)[1]
        grams = grams[:-1] * n_codes + codes[i:]
    return np.unique(grams, return_inverse=True)[1] if n > 2 else grams


def gram_array(tokens: Column | str, n: int) -> Column:
    """N-grams of a token array, their tokens joined by ``_``."""
    tokens = grams = as_column(tokens)
    for i in range(1, n):
        # The shorter rest is padded with NULL, and what touches its end becomes NULL.
        rest = F.slice(tokens, i + 1, F.size(tokens))
        grams = F.zip_with(grams, rest, lambda x, y: F.concat(x, F.lit("_"), y))
    return F.array_compact(grams) if n > 1 else grams


def repeats(grams: Column | str) -> Column:
    """``gram#2``, ``gram#3``, ...: the occurrences after the first one."""
    runs = F.regexp_extract_all(F.array_join(F.sort_array(as_column(grams)), " "), F.lit(RUN), F.lit(0))

    def later(run: Column) -> Column:
        gram = F.substring_index(run, " ", 1)
        count = ((F.length(run) + 1) / (F.length(gram) + 1)).cast("int")
        return F.transform(F.sequence(F.lit(2), count), lambda k: F.concat(gram, F.lit("#"), k.cast("string")))

    return F.flatten(F.transform(runs, later))


def shared(reference: Column | str, candidate: Column | str) -> Column:
    """Overlap of two n-gram arrays, clipped by counts."""
    reference, candidate = as_column(reference), as_column(candidate)
    once = F.size(F.array_intersect(reference, candidate))
    return once + F.size(F.array_intersect(repeats(reference), repeats(candidate)))
