"""Scalar text functions: normalizers, cleaners, parsers and tokenizers."""

from __future__ import annotations

import re
from collections.abc import Mapping
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# Markers found in generated text and judge answers.
REASONING_TAG = "<think>"
INSTRUCTION_END = "[/INST]"
SCORE_PATTERN = r'"score":\s*["\']?(\d+)["\']?'
# Fixed value: name of the processed-list file in each volume folder.
CHECKPOINT_FILE = "checkpoint.txt"
# Fixed value: the alphabet of the ROUGE tokenizer.
WORD_PATTERN = "[a-z0-9]+"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(text: Column | str) -> Column:
    """Trim every Unicode blank on both ends (Spark's ``trim`` only trims U+0020)."""
    return F.btrim(as_column(text), F.lit(WHITESPACE))


def normalize_title(title: Column | str) -> Column:
    """Stripped, lower-case title with ``_`` for spaces and without ``:`` and ``,``."""
    return F.lower(F.translate(strip(title), " :,", "_"))


def checkpoint_key(name: Column | str) -> Column:
    """Normalized title of a processed-list entry, which may be a title or a ``.pdf`` name.

    NULL for blank entries and for the list's own file, so that they count as nothing.
    """
    key = normalize_title(F.regexp_replace(strip(name), r"(?i)\.pdf$", ""))
    return F.when(~key.isin("", CHECKPOINT_FILE), key)


def normalize_file_name(name: Column | str) -> Column:
    """File name as a manifest key: no ``.pdf``, no outer quotes, only ``[a-z0-9_]``."""
    stem = F.regexp_replace(as_column(name), r"(?i)\.pdf$", "")
    unquoted = F.lower(F.btrim(stem, F.lit("'\"")))
    return F.regexp_replace(F.translate(unquoted, " ", "_"), "[^a-zA-Z0-9_]", "")


def safe_model_name(model: Column | str) -> Column:
    """Model name usable in a path."""
    return F.translate(as_column(model), ":/", "__")


def output_name(file_name: Column | str) -> Column:
    """Converted file's name for a ``.pdf`` input."""
    return F.replace(as_column(file_name), F.lit(".pdf"), F.lit(".md"))


def url_segment(url: Column | str, position: int = -2) -> Column:
    """Path piece counted from the end (``-2`` = venue or volume); NULL when there are too few."""
    return F.try_element_at(F.split(as_column(url), "/"), F.lit(position))


def strip_reasoning(text: Column | str, trim: bool = True) -> Column:
    """Last blank-line separated block of an answer that starts with a reasoning tag."""
    text = as_column(text)
    tail = F.element_at(F.split(text, "\n\n"), -1)
    return F.when(F.startswith(text, F.lit(REASONING_TAG)), strip(tail) if trim else tail).otherwise(text)


def strip_prompt_echo(response: Column | str, prompt: Column | str) -> Column:
    """Answer without the prompt: text after the last instruction end, else prompt removed."""
    response, prompt = as_column(response), as_column(prompt)
    without = F.when(F.coalesce(prompt, F.lit("")) == "", response).otherwise(
        F.replace(response, prompt, F.lit(""))
    )
    after = F.substring_index(response, INSTRUCTION_END, -1)
    return strip(F.when(F.contains(response, F.lit(INSTRUCTION_END)), after).otherwise(without))


def generation_length(text: Column | str) -> Column:
    """Characters of the stripped generation."""
    return F.length(strip(text))


def default_field(value: Column | str, default: str) -> Column:
    """Value, or the default for a missing or null field."""
    return F.coalesce(as_column(value), F.lit(default))


def source_article(title: Column | str, content: Column | str) -> Column:
    """Title, blank line and content; an empty part is left out together with its separator."""
    head, body = default_field(title, ""), default_field(content, "")
    return F.concat(F.when(head != "", F.concat(head, F.lit("\n\n"))).otherwise(F.lit("")), body)


def join_sections(sections: Column | str) -> Column:
    """Section array as one text."""
    return F.array_join(as_column(sections), " ")


def has_score(response: str | None) -> bool:
    """Whether ``judge_score`` reads a score from an answer; for hooks inside Python tasks."""
    found = re.search(SCORE_PATTERN, response or "", re.ASCII)  # as Java reads digits and blanks
    return found is not None and int(found[1]) < 1 << 31


def judge_score(response: Column | str) -> Column:
    """First whole-number score in a judge's answer, NULL when there is none."""
    digits = F.regexp_extract(as_column(response), SCORE_PATTERN, 1)
    return F.nullif(digits, F.lit("")).try_cast("int")


def render_template(template: str, fields: Mapping[str, Column | str]) -> Column:
    """Fill ``{name}`` placeholders with columns; ``{{`` and ``}}`` are literal braces."""
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(F.coalesce(as_column(fields[name]), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def words(text: Column | str) -> Column:
    """ROUGE tokens: lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(as_column(text)), F.lit(WORD_PATTERN), F.lit(0))


def word_text(text: Column | str) -> Column:
    """The ROUGE tokens of a text as one text, separated by single spaces."""
    spaced = F.regexp_replace(F.lower(as_column(text)), "[^a-z0-9]+", " ")
    return F.btrim(spaced)


def split_words(text: Column | str) -> Column:
    """Token array of a ``word_text``."""
    return F.array_remove(F.split(as_column(text), " "), "")


def whitespace_tokens(text: Column | str) -> Column:
    """Pieces between ASCII blanks; stands in for model tokens."""
    return F.regexp_extract_all(as_column(text), F.lit("[^ \\t\\r\\n]+"), F.lit(0))


def shifted(tokens: Column | str, n: int) -> Column:
    """Structs ``w0 .. w{n-1}`` of every position's next tokens; NULL past the end."""
    tokens = as_column(tokens)
    ahead = [F.slice(tokens, i + 1, F.size(tokens)).alias(f"w{i}") for i in range(1, n)]
    return F.arrays_zip(tokens.alias("w0"), *ahead)


def word_ngrams(tokens: Column | str, n: int) -> Column:
    """Space-joined n-grams of a token array, in order."""
    count = F.greatest(F.size(as_column(tokens)) - (n - 1), F.lit(0))
    whole = F.slice(shifted(tokens, n), 1, count)
    return F.transform(whole, lambda g: F.concat_ws(" ", *[g[f"w{i}"] for i in range(n)]))


def decode_bytes(content: Column | str) -> Column:
    """Bytes as text: UTF-8 when valid, else Latin-1."""
    content = as_column(content)
    return F.when(F.is_valid_utf8(content.cast("string")), F.decode(content, "UTF-8")).otherwise(
        F.decode(content, "ISO-8859-1")
    )
