"""License scans by conditional compression: templates as raw dictionaries, winners confirmed by wording."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm.license_texts import TEMPLATES
from folioframe.llm.words import byte_column, in_batches

# What a line of a licence or of a notice holds.
_TRIGGER = re.compile(
    rb"licen[cs]e|copyright|permission is|redistribut|warrant|public domain|\"as is\"|all rights reserved|liab", re.I
)
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
#: Words that tell licences apart: names, kinds, versions. A bare number is one after a word of
#: _BEFORE_NUMBER only, as the clauses of a licence are numbered too.
_TELLING = re.compile(
    r".*\d.*[.\-a-z].*|.*[.\-a-z].*\d.*|lesser|affero|general|library-general|mit|isc|x11|zlib|bsd|apache|gnu|mozilla|eclipse|mpl|epl|"
    r"[al]?gpl.*|cc|by-.*|nc|nd|sa|cc-.*|creative|commons|(?:attribution|non-?commercial|no-?deriv|share-?alike).*|public-domain"
)
_BEFORE_NUMBER = re.compile(r"versions?|v|licen[cs]es?|[al]?gpl|mpl|epl|apache|bsd|by.*|cc|attribution.*")
_LIBRARY = re.compile(r"\blibrary\s+general\b", re.I)
#: Cost of a difference on such a word.
_NEVER = 1 << 20
#: Lines without a trigger that may lie inside a block, and the most lines of a block.
_GAP, _BLOCK_LINES = 2, 64
_MATCHES = pa.list_(pa.struct([
    ("license", pa.string()), ("first_line", pa.int32()), ("last_line", pa.int32()), ("reduction", pa.float64()),
    ("differences", pa.int32()),
]))
_SCAN = pa.schema([("doc_id", pa.int64()), ("n_blocks", pa.int64()), ("matches", _MATCHES)])


def candidate_blocks(data: bytes) -> list[tuple[int, int, bytes]]:
    """``(first line, last line, bytes)`` of runs of lines that may be a licence's words.

    A run begins and ends with a line that holds a trigger, with at most two other lines between
    such lines. A run longer than 64 lines is several blocks.
    """
    if not _TRIGGER.search(data):
        return []
    lines = data.split(b"\n")
    hits = [i for i, line in enumerate(lines) if _TRIGGER.search(line)]
    runs: list[list[int]] = []
    for i in hits:
        if runs and i - runs[-1][1] <= _GAP + 1 and i - runs[-1][0] < _BLOCK_LINES:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    return [(first, last, b"\n".join(lines[first : last + 1])) for first, last in runs]


def word_places(text: str) -> list[tuple[str, int, int, int]]:
    """``(word, begin, end, line)`` of the words of a text, in small letters; "library general" has a hyphen."""
    text = _LIBRARY.sub(lambda m: m[0][:7] + "-" * (len(m[0]) - 14) + m[0][-7:], text)
    out, line, seen = [], 0, 0
    for found in _WORD.finditer(text):
        line += text.count("\n", seen, found.start())
        seen = found.start()
        out.append((found[0].lower(), *found.span(), line))
    return out


def telling(words: Sequence[str]) -> np.ndarray:
    """Which words tell licences apart."""
    return np.array([
        bool(_BEFORE_NUMBER.fullmatch(before)) if word.isdecimal() else bool(_TELLING.fullmatch(word))
        for before, word in zip(["", *words], words)
    ], bool)


def last_row(
    words: Sequence[str], other: Sequence[str], anywhere: bool = True, costs: Sequence[np.ndarray] | None = None,
) -> np.ndarray:
    """By end in ``other``, the least cost to insert, delete or replace words until ``words`` is a part that ends there.

    The part begins anywhere, or at the first word. ``costs`` has the cost of a difference on each
    word of both, else 1; replacing costs the larger. Rows of the distance table are computed at once.
    """
    codes = np.array([hash(w) for w in other], np.int64)
    own, others = costs or (np.ones(len(words), np.int64), np.ones(len(codes), np.int64))
    steps = np.append(0, np.cumsum(others))
    row = np.zeros(len(codes) + 1, np.int64) if anywhere else steps
    for word, cost in zip(words, own):
        replaced = row[:-1] + (codes != hash(word)) * np.maximum(others, cost)
        down = np.append(row[0] + cost, np.minimum(replaced, row[1:] + cost))
        row = np.minimum.accumulate(down - steps) + steps
    return row


def wording_differences(words: Sequence[str], template: Sequence[str], costs: Sequence[np.ndarray] | None = None) -> int:
    """Least cost to insert, delete or replace words until the words are a part of the template, anywhere in it."""
    return int(last_row(words, template, costs=costs).min())


def part_spans(
    words: Sequence[str], template: Sequence[str], most: int, costs: Sequence[np.ndarray] | None = None,
) -> list[tuple[int, int, int]]:
    """``(differences, begin, end)`` of non-overlapping parts of ``words`` that differ from the template in ``most`` words or fewer.

    ``costs`` are those of ``words`` and of the template.

    ``most`` differences leave one of ``most + 1`` pieces of the template whole, so only the
    surroundings of such pieces are aligned. Of overlapping parts the one of fewest differences stays.
    """
    n, joined = len(template), f" {' '.join(words)} "
    given, own = costs or (np.ones(len(words), np.int64), np.ones(n, np.int64))
    begins = np.cumsum([0] + [len(w) + 1 for w in words])
    cuts = np.linspace(0, n, min(most, n - 1) + 2).astype(int)
    around: list[tuple[int, int]] = []
    for first, last in zip(cuts, cuts[1:]):
        piece, place = f" {' '.join(template[first:last])} ", -1
        while (place := joined.find(piece, place + 1)) >= 0:
            begin = int(np.searchsorted(begins, place)) - int(first)
            around.append((max(0, begin - most), min(len(words), begin + n + most)))
    areas: list[list[int]] = []
    for begin, end in sorted(around):
        if areas and begin <= areas[-1][1]:
            areas[-1][1] = max(areas[-1][1], end)
        else:
            areas.append([begin, end])
    spans: list[tuple[int, int, int]] = []
    for begin, end in areas:
        ends = last_row(template, words[begin:end], costs=(own, given[begin:end]))
        taken = np.zeros(end - begin + 1, bool)
        for place in np.argsort(ends, kind="stable"):
            if ends[place] > most:
                break
            if place == 0 or taken[place]:
                continue
            near = slice(max(begin, begin + place - n - most), begin + place)
            back = last_row(template[::-1], words[near][::-1], False, (own[::-1], given[near][::-1]))
            start = int(place) - int(back.argmin())
            if start < place and not taken[start + 1 : place + 1].any():
                taken[start + 1 : place + 1] = True
                spans.append((int(ends[place]), begin + start, begin + int(place)))
    return spans


class Templates:
    """The licences' wordings, each with a compressor that has it as its raw dictionary."""

    def __init__(self, texts: Mapping[str, Sequence[str]], level: int = 9):
        self.plain = zstandard.ZstdCompressor(level=level, write_content_size=False)
        self.known = []
        for name, wordings in texts.items():
            # a licence may name itself once more
            spoken = {word for wording in wordings for word, *_ in word_places(wording)}
            for wording in wordings:
                data = wording.encode()
                raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                compressor = zstandard.ZstdCompressor(level=level, dict_data=raw, write_content_size=False, write_dict_id=False)
                words = [word for word, *_ in word_places(wording)]
                self.known.append((name, compressor, words, np.where(telling(words), _NEVER, 1), spoken))

    @staticmethod
    def costs(words: Sequence[str], marks: np.ndarray, spoken: set[str]) -> np.ndarray:
        """The cost of a difference on each word of a text: none may fall on words that tell of another licence."""
        return np.where(marks & np.array([word not in spoken for word in words], bool), _NEVER, 1)

    def reduction(self, compressor: zstandard.ZstdCompressor, part: bytes) -> float:
        return 1 - len(compressor.compress(part)) / len(self.plain.compress(part))

    def whole(self, data: bytes, share: float, least: float) -> list[tuple]:
        """``(license, reduction, differences, first line, last line)`` of whole wordings in a text, without overlaps."""
        text = data.decode("utf-8", "replace")
        places = word_places(text)
        words, found = [word for word, *_ in places], []
        marks = telling(words)
        for name, compressor, wording, own, spoken in self.known:
            if len(wording) < 3:
                continue
            costs = self.costs(words, marks, spoken), own
            for differences, begin, end in part_spans(words, wording, int(share * len(wording)), costs):
                found.append((differences - len(wording), differences, name, begin, end, compressor))
        found.sort(key=lambda x: x[:5])
        taken, out = np.zeros(len(words), bool), []
        for _, differences, name, begin, end, compressor in found:
            if taken[begin:end].any():
                continue
            part = text[places[begin][1] : places[end - 1][2]].encode()
            if (reduction := self.reduction(compressor, part)) >= least:
                taken[begin:end] = True
                out.append((name, reduction, differences, places[begin][3], places[end - 1][3]))
        return sorted(out, key=lambda x: x[3:])

    def part(self, block: bytes, least: float, share: float) -> tuple[str, float, int] | None:
        """``(license, reduction, differences)`` of the best wording that has the block as a part of it.

        None when the wordings of several licences have it equally well.
        """
        words, found = [word for word, *_ in word_places(block.decode("utf-8", "replace"))], []
        marks = telling(words)
        for name, compressor, wording, own, spoken in self.known:
            if 3 <= len(words) <= len(wording) and (reduction := self.reduction(compressor, block)) >= least:
                differences = wording_differences(words, wording, (self.costs(words, marks, spoken), own))
                if differences <= share * len(words):
                    found.append((differences, -reduction, name))
        if not found or len({name for differences, _, name in found if differences == min(found)[0]}) > 1:
            return None
        return min(found)[2], -min(found)[1], min(found)[0]


def scan_licenses(
    docs: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, least_reduction: float = 0.25,
    difference_share: float = 0.1, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(doc_id, n_blocks, licenses, matches)`` for every row of ``docs``.

    A text that holds a trigger word is searched for every template as a whole: any part of it that
    differs from a template in at most ``difference_share`` of the template's words is found,
    whatever stands around it. No difference may fall on a word that tells licences apart: a name, a kind
    (lesser, affero, noderivatives) or a version. Of overlapping parts the one of most equal words stays, and of those the
    one of fewest differences. Each is compressed by itself and with its template as zstandard raw
    dictionary, and confirmed when the dictionary saves ``least_reduction`` of its size or more.

    Runs of lines that hold a trigger word are candidate blocks. A block without a whole template may be
    a part of one: the templates that save ``least_reduction`` of its size are confirmed by
    wording, the block having to be a part of the template up to ``difference_share`` of the
    block's words, and the one of fewest differences wins. A block that is equally part of several
    licences names none.

    ``matches`` lists license, first and last line from 0, reduction and differences of every
    confirmed part or block; ``licenses`` the distinct identifiers in order. A null or empty text has no
    blocks. Ties go to the larger reduction, then the name. Repeated rows are scanned each; other
    columns are ignored.
    """
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    wordings = {name: list(texts) for name, texts in templates.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(wordings)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for one, data in zip(batch.column("doc_id").to_pylist(), byte_column(batch, "text"), strict=True):
                    blocks = candidate_blocks(data)
                    found = known.whole(data, difference_share, least_reduction) if blocks else []
                    for first, last, block in blocks:
                        if not any(m[3] <= last and first <= m[4] for m in found):
                            if won := known.part(block, least_reduction, difference_share):
                                found.append((*won, first, last))
                    found.sort(key=lambda m: m[3:])
                    matches = [
                        dict(zip(("license", "reduction", "differences", "first_line", "last_line"), m, strict=True)) for m in found
                    ]
                    yield one, len(blocks), matches

        yield from in_batches(rows(), _SCAN)

    scanned = source.mapInArrow(run, (
        "doc_id bigint, n_blocks bigint, matches array<struct<license: string, first_line: int, last_line: int, "
        "reduction: double, differences: int>>"
    ))
    return scanned.select("doc_id", "n_blocks", F.array_sort(F.array_distinct(F.col("matches.license"))).alias("licenses"), "matches")
