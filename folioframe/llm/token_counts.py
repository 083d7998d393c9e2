"""Token counts of whole texts by a sentencepiece model, in batches balanced by bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm.words import byte_column

_BLANK = "▁"
_COUNT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])
#: A blank between two characters that are neither a blank nor the model's sign for one.
_SAFE = re.compile(f"(?<=[^ {_BLANK}]) (?=[^ {_BLANK}])")


def split_is_safe(processor) -> bool:
    """Whether no piece of the model goes on past a blank, so a text may be cut at one.

    The model marks a blank by U+2581 and puts one before a text, so the right half of a text
    cut at a single blank is encoded as it would be inside the text, if no piece holds the sign
    after another character.
    """
    pieces = map(processor.id_to_piece, range(processor.get_piece_size()))
    inner = all(_BLANK not in piece.lstrip(_BLANK) for piece in pieces)
    halves = (processor.encode("a b"), processor.encode("a") + processor.encode("b"))
    return inner and halves[0] == halves[1]


def safe_parts(text: str, size: int) -> list[str]:
    """Parts of about ``size`` characters, cut at safe blanks, which are left out."""
    parts, begin = [], 0
    while len(text) - begin > size:
        cut = _SAFE.search(text, begin + size)
        if cut is None:
            break
        parts.append(text[begin : cut.start()])
        begin = cut.end()
    parts.append(text[begin:])
    return parts


def count_tokens(
    docs: DataFrame, model: str, limit: int = 4096, batch_bytes: int = 1 << 20, part_chars: int = 1 << 14,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` a row of ``docs``; lengths only leave the task.

    ``model`` is the path of a sentencepiece model that every executor has. Texts go to the
    library in batches of about ``batch_bytes``, not of so many rows; a text longer than
    ``part_chars`` is cut at safe blanks, so a batch never grows with its longest text where
    that has blanks. No begin, end or special tokens are added. A null text is empty: 0 bytes,
    0 tokens. Repeated rows are counted each, other columns are ignored.
    """
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        part_size = part_chars if split_is_safe(processor) else 1 << 62
        for batch in batches:
            data = byte_column(batch, "text")
            counts, held, owners, size = [0] * len(data), [], [], 0

            def count() -> None:
                for owner, ids in zip(owners, processor.encode(held, num_threads=1), strict=True):
                    counts[owner] += len(ids)

            for row, raw in enumerate(data):
                for part in safe_parts(raw.decode("utf-8", "replace"), part_size):
                    held.append(part)
                    owners.append(row)
                    size += len(part)
                    if size >= batch_bytes:
                        count()
                        held, owners, size = [], [], 0
            count()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(map(len, data), pa.int64()), pa.array(counts, pa.int64()),
                pa.array([n > limit for n in counts], pa.bool_()),
            ], schema=_COUNT)

    return source.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
