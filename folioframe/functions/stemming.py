"""English stemming of token texts: Porter, "An algorithm for suffix stripping" (1980), with
the widely used later additions (irregular words, short words, ``-logi`` and ``-fulli``).

The suffix rules are data. A token is stemmed once per part of an Arrow batch, whatever its count: many tokens as rows
of letters, a rule at a time, few or long ones by themselves, and a task keeps the stems of those.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from folioframe.functions.tokens import text_bytes

# The published suffix rules. Steps 2 and 3 need a measure above 0, step 4 one
# above 1.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize",
    "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful",
    "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "fulli": "ful",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}
# Fixed value: shorter tokens are left alone by the scorer.
MIN_LENGTH = 4
#: Words whose stems a task keeps.
MOST_KNOWN = 1 << 16
#: So many words are stemmed as rows of letters, those of at most so many bytes, in blocks of rows.
MANY, WIDTH, BLOCK = 1 << 9, 32, 1 << 15
_VOWEL = np.zeros(256, bool)
_VOWEL[list(b"aeiou")] = True


def _shape(text: str) -> str:
    """Each letter as v or c; y is a vowel after a consonant."""
    marks = ""
    for letter in text:
        vowel = letter in "aeiou" or (letter == "y" and marks.endswith("c"))
        marks += "v" if vowel else "c"
    return marks


def _measure(text: str) -> int:
    return len(re.findall("v+c", _shape(text)))


def _short_end(text: str) -> bool:
    shape = _shape(text)
    return shape == "vc" or (shape.endswith("cvc") and text[-1] not in "wxy")


def _suffix(word: str, candidates) -> str | None:
    return max((s for s in candidates if word.endswith(s)), key=len, default=None)


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    ending = _suffix(word, ("ed", "ing"))
    base = word[: -len(ending)] if ending else ""
    if "v" not in _shape(base):
        return word
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if len(base) > 1 and base[-1] == base[-2] and _shape(base).endswith("c"):
        return base if base[-1] in "lsz" else base[:-1]
    return base + "e" if _measure(base) == 1 and _short_end(base) else base


def _derived(word: str) -> str:
    if word.endswith("logi") and _measure(word[:-3]) > 0:
        return word[:-1]
    ending = _suffix(word, STEP_2)
    base = word[: -len(ending)] if ending else ""
    if not ending or _measure(base) == 0:
        return word
    return _derived(base + "al") if ending == "alli" else base + STEP_2[ending]


def _reduced(word: str) -> str:
    ending = _suffix(word, STEP_3)
    base = word[: -len(ending)] if ending else ""
    return base + STEP_3[ending] if ending and _measure(base) > 0 else word


def _bare(word: str) -> str:
    ending = _suffix(word, STEP_4)
    base = word[: -len(ending)] if ending else ""
    if not ending or _measure(base) < 2 or (ending == "ion" and base[-1] not in "st"):
        return word
    return base


def _tidy(word: str) -> str:
    base = word[:-1]
    if word.endswith("e") and (_measure(base) > 1 or (_measure(base) == 1 and not _short_end(base))):
        word = base
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def stem(word: str) -> str:
    """Stem of a lower-case word."""
    if len(word) < MIN_LENGTH:
        return word
    if word in IRREGULAR:
        return IRREGULAR[word]
    word = _past(_plural(word))
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1]).endswith("c"):
        word = word[:-1] + "i"
    return _tidy(_bare(_reduced(_derived(word))))


class Spelled(NamedTuple):
    """Words as rows of letters, of which each has a number."""

    letters: np.ndarray
    sizes: np.ndarray

    def ending(self, rows: np.ndarray, suffix: str) -> np.ndarray:
        """Those of some rows that end so."""
        rows = rows[self.sizes[rows] >= len(suffix)]
        for i, letter in enumerate(reversed(suffix.encode()), 1):
            rows = rows[self.letters[rows, self.sizes[rows] - i] == letter]
        return rows

    def last(self, rows: np.ndarray, dropped: int, letters: str) -> np.ndarray:
        """Whether the letter before the last ``dropped`` is one of some; those rows have it."""
        return np.isin(self.letters[rows, self.sizes[rows] - dropped - 1], list(letters.encode()))

    def turn(self, rows: np.ndarray, dropped: int, added: str = "") -> None:
        """Replace the last letters."""
        self.sizes[rows] -= dropped
        for letter in added.encode():
            self.letters[rows, self.sizes[rows]] = letter
            self.sizes[rows] += 1

    def shapes(self, rows: np.ndarray, dropped: int) -> Shapes:
        """What ``_shape`` tells of words without their last letters."""
        sizes = self.sizes[rows] - dropped
        letters = self.letters[rows, : max(int(sizes.max(initial=1)), 1)]
        vowel, y = _VOWEL[letters], letters == ord("y")
        for j in np.flatnonzero(y.any(axis=0)).tolist():
            if j:
                vowel[:, j] |= y[:, j] & ~vowel[:, j - 1]
        inside = np.arange(letters.shape[1]) < sizes[:, None]
        measure = (vowel[:, :-1] & ~vowel[:, 1:] & inside[:, 1:]).sum(axis=1)
        all_rows = np.arange(len(rows))
        ends = [(sizes >= k) & (vowel[all_rows, np.maximum(sizes - k, 0)] == (k == 2)) for k in (1, 2, 3)]
        soft = (sizes >= 1) & np.isin(letters[all_rows, np.maximum(sizes - 1, 0)], list(b"wxy"))
        short = ends[0] & ends[1] & ((sizes == 2) | (ends[2] & ~soft))
        return Shapes(measure, (vowel & inside).any(axis=1), ends[0], short)


class Shapes(NamedTuple):
    """The measure of words, whether they have a vowel, end in a consonant and have a short end."""

    measure: np.ndarray
    voiced: np.ndarray
    closed: np.ndarray
    short: np.ndarray


def _longest(words: Spelled, rows: np.ndarray, candidates) -> dict[str, np.ndarray]:
    """The rows of each suffix that is the longest one of its word."""
    found, by_letter = {}, {}
    last = words.letters[rows, words.sizes[rows] - 1]
    for suffix in sorted(candidates, key=len, reverse=True):
        if suffix[-1] not in by_letter:
            by_letter[suffix[-1]] = rows[last == ord(suffix[-1])]
        held = words.ending(by_letter[suffix[-1]], suffix)
        taken = [found[s] for s in found if s.endswith(suffix)]
        found[suffix] = np.setdiff1d(held, np.concatenate(taken)) if taken else held
    return found


def _replaced(words: Spelled, rows: np.ndarray, rules: dict[str, str]) -> None:
    """Longest suffixes replaced after a measure above 0."""
    for suffix, held in _longest(words, rows, rules).items():
        words.turn(held[words.shapes(held, len(suffix)).measure > 0], len(suffix), rules[suffix])


def _turn_past(words: Spelled, rows: np.ndarray) -> None:
    found = _longest(words, rows, ("ied", "eed", "ed", "ing"))
    small = words.sizes[found["ied"]] == 4
    words.turn(found["ied"][small], 1)
    words.turn(found["ied"][~small], 2)
    words.turn(found["eed"][words.shapes(found["eed"], 3).measure > 0], 1)
    for ending in ("ed", "ing"):
        rows = found[ending]
        rows = rows[words.shapes(rows, len(ending)).voiced]
        words.turn(rows, len(ending))
        shapes = words.shapes(rows, 0)
        opened = np.zeros(len(rows), bool)
        for two in ("at", "bl", "iz"):
            opened |= np.isin(rows, words.ending(rows, two))
        sizes = words.sizes[rows]
        double = (sizes > 1) & (words.letters[rows, sizes - 1] == words.letters[rows, np.maximum(sizes - 2, 0)]) & shapes.closed & ~opened
        opened |= ~double & (shapes.measure == 1) & shapes.short
        words.turn(rows[double & ~words.last(rows, 0, "lsz")], 1)
        words.turn(rows[opened], 0, "e")


def _stem_rows(words: Spelled) -> None:
    """``stem`` of words that are no exceptions, in place."""
    rows = np.flatnonzero(words.sizes >= MIN_LENGTH)
    found = _longest(words, rows, ("ies", "sses", "ss", "s"))
    small = words.sizes[found["ies"]] == 4
    for held, dropped in ((found["ies"][small], 1), (found["ies"][~small], 2), (found["sses"], 2), (found["s"], 1)):
        words.turn(held, dropped)
    _turn_past(words, rows)
    held = words.ending(rows, "y")
    held = held[words.sizes[held] > 2]
    words.turn(held[words.shapes(held, 1).closed], 1, "i")
    held = words.ending(rows, "logi")
    words.turn(held[words.shapes(held, 3).measure > 0], 1)
    _replaced(words, rows, {"alli": STEP_2["alli"]})
    _replaced(words, rows, STEP_2)
    _replaced(words, rows, STEP_3)
    for suffix, held in _longest(words, rows, STEP_4).items():
        held = held[words.shapes(held, len(suffix)).measure > 1]
        words.turn(held[words.last(held, 3, "st")] if suffix == "ion" else held, len(suffix))
    held = words.ending(rows, "e")
    shapes = words.shapes(held, 1)
    words.turn(held[(shapes.measure > 1) | (shapes.measure == 1) & ~shapes.short], 1)
    held = words.ending(rows, "ll")
    words.turn(held[words.shapes(held, 1).measure > 1], 1)


def stems(words: pa.Array) -> pa.Array:
    """``stem`` of many words, without nulls."""
    as_rows = pc.and_(pc.string_is_ascii(words), pc.less_equal(pc.binary_length(words), WIDTH))
    as_rows = pc.and_(as_rows, pc.invert(pc.is_in(words, pa.array(list(IRREGULAR)))))
    places = np.flatnonzero(as_rows.to_numpy(zero_copy_only=False))
    out = [pa.array([stem(w) for w in words.filter(pc.invert(as_rows)).to_pylist()], pa.string())]
    for i in range(0, len(places), BLOCK):
        raw, begins = text_bytes(words.take(pa.array(places[i : i + BLOCK])))
        held = np.arange(WIDTH)
        spelled = Spelled(np.append(raw, np.uint8(0))[np.minimum(begins[:-1, None] + held, len(raw))], np.diff(begins))
        _stem_rows(spelled)
        offsets = np.concatenate([[0], np.cumsum(spelled.sizes)]).astype(np.int32)
        letters = spelled.letters[held < spelled.sizes[:, None]]
        out.append(pa.StringArray.from_buffers(len(spelled.sizes), pa.py_buffer(offsets), pa.py_buffer(letters)))
    order = np.empty(len(words), np.int64)
    order[np.concatenate([np.flatnonzero(~as_rows.to_numpy(zero_copy_only=False)), places])] = np.arange(len(words))
    return pa.concat_arrays(out).take(pa.array(order))


def stem_codes(words: pa.Array, known: dict[str, str]) -> np.ndarray:
    """A number for each of some words, which may have blanks around them, equal for equal stems.

    ``known`` keeps the stems of words for the next call, ``MOST_KNOWN`` and those of one call at most. ``MANY`` words
    are stemmed together, which costs less than to look them up.
    """
    if len(words) >= MANY:
        return _numbers(stems(pc.utf8_trim_whitespace(words)))
    if len(known) > MOST_KNOWN:
        known.clear()
    spelled = words.to_pylist()
    for word in spelled:
        if word not in known:
            known[word] = stem(word.strip())
    return _numbers(pa.array([known[w] for w in spelled], pa.string()))


def _numbers(words: pa.Array) -> np.ndarray:
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)
