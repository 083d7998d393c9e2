"""Dense features of one text for the toxicity model, inside Python tasks."""

from __future__ import annotations

import re

import numpy as np

# Second-person words of the corpus languages.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deinem deiner ihr euch euer eure sie ihnen tu te toi "
    "ton ta tes vous votre vos tú ti usted ustedes vosotros vuestro vuestra tuyo tus".split()
)
# Signs that stand for letters in disguised words.
_DISGUISE = str.maketrans("013457@$!|", "oieastasil")
_EDGES = "\"'()[]{}<>.,;:!?*_~-–—…«»„“”¡¿"
_INNER = re.compile(r"(?<=\w)[\W_]+(?=\w)")
_LETTER = re.compile(r"[^\W\d_]")
#: Lengths of word beginnings that the lexicon knows as stems.
STEMS = (4, 5, 6)
#: How many words apart a lexicon word and a second-person word are near.
_NEAR = 4

FEATURES = (
    "word_density", "word_hits", "stem_density", "stem_hits", "weight_most", "weight_mean", "near_second_person",
    "second_person_density", "capitals", "shouted_words", "exclamations", "questions", "punctuation", "disguised_density",
    "disguised_hits", "length",
)


def token_forms(text: str) -> list[tuple[str, str, bool]]:
    """``(plain form, undisguised form, disguised)`` of every run without white space.

    The plain form is lower-cased and without marks at its edges. The undisguised form reads
    digits and signs inside a word as the letters they stand for and leaves out other marks; a
    token is disguised when it has a letter and the two forms differ.
    """
    forms = []
    for token in text.lower().split():
        if token.isalpha():
            forms.append((token, token, False))
            continue
        plain = token.strip(_EDGES)
        if plain.isalpha():
            forms.append((plain, plain, False))
            continue
        open_form = _INNER.sub("", plain.translate(_DISGUISE))
        letters = len(_LETTER.findall(plain))
        disguised = 2 * letters >= len(plain) > 0 and open_form != plain
        forms.append((plain, open_form if disguised else plain, disguised))
    return forms


def lexicon_terms(text: str) -> set[str]:
    """The distinct words of a text, and their beginnings as ``beginning*``."""
    terms: set[str] = set()
    for _, word, _ in token_forms(text):
        if 2 <= len(word) <= 40:
            terms.add(word)
            terms.update(word[:n] + "*" for n in STEMS if len(word) > n)
    return terms


class Featurizer:
    """Turns a text into the dense vector of ``FEATURES``, given term weights (log odds)."""

    def __init__(self, weights: dict[str, float]):
        self.words = {term: weight for term, weight in weights.items() if not term.endswith("*")}
        self.stems = {term[:-1]: weight for term, weight in weights.items() if term.endswith("*")}
        self.lengths = sorted({len(stem) for stem in self.stems})

    def _weight(self, word: str) -> tuple[float, float]:
        stem = max((self.stems.get(word[:n], 0.0) for n in self.lengths if len(word) >= n), default=0.0)
        return self.words.get(word, 0.0), stem

    def __call__(self, text: str) -> list[float]:
        forms = token_forms(text)
        n = max(len(forms), 1)
        seen: dict[str, tuple[float, float]] = {}
        word_hits = stem_hits = disguised = disguised_hits = 0
        places, weights = [], []
        second = [i for i, (plain, _, _) in enumerate(forms) if plain in SECOND_PERSON]
        for i, (_, word, hidden) in enumerate(forms):
            if word not in seen:
                seen[word] = self._weight(word)
            known, stem = seen[word]
            disguised += hidden
            if known or stem:
                word_hits += known > 0
                stem_hits += stem > 0
                disguised_hits += hidden
                places.append(i)
                weights.append(max(known, stem))
        near = 0
        if second and places:
            at = np.array(second)
            after = np.searchsorted(at, places)
            gaps = np.minimum(
                np.abs(at[np.minimum(after, len(at) - 1)] - places), np.abs(at[np.maximum(after - 1, 0)] - places)
            )
            near = int((gaps <= _NEAR).sum())
        letters = sum(map(str.isalpha, text)) or 1
        capitals = sum(map(str.isupper, text))
        shouted = sum(len(t) > 2 and t.isupper() for t in text.split())
        marks = sum(text.count(c) for c in ".,;:!?-")
        size = max(len(text), 1)
        return [
            word_hits / n, np.log1p(word_hits), stem_hits / n, np.log1p(stem_hits), max(weights, default=0.0),
            sum(weights) / n, near / n, len(second) / n, capitals / letters, shouted / n, text.count("!") / n,
            text.count("?") / n, marks / size, disguised / n, disguised_hits / n, np.log1p(len(forms)),
        ]
