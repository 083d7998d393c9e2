"""Batch hooks for user-supplied models, and deterministic stand-ins for tests.

A hook gets an iterator factory: ``make()`` runs once per task and returns the function for a
batch, so a client or a model is opened once per partition. Rows are keyed, and a rerun of a
task writes the same keys again.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.functions.text import has_score

Generate = Callable[[Sequence[str], Sequence[str], dict], list[str | None]]
Encode = Callable[[Sequence[str]], list[Sequence[float]]]
Judge = Callable[[Sequence[str], int], list[str | None]]
Evaluate = Callable[[Sequence[str], Sequence[str], Sequence[str]], list[dict[str, float] | None]]


def _answers(call: Callable[..., Sequence], *columns: Sequence) -> list:
    """Batch answers; when the batch call raises, row by row with None for the failing rows."""
    try:
        return list(call(*columns))
    except Exception:
        answers = []
        for row in zip(*columns):
            try:
                answers.append(list(call(*[[value] for value in row]))[0])
            except Exception:
                answers.append(None)
        return answers


def _calls(n_rows: int, size: int) -> Iterator[slice]:
    """The rows of each call; what the calls of a batch give goes out as one frame, as small ones cost more than the calls."""
    return (slice(start, min(start + size, n_rows)) for start in range(0, n_rows, size))


def _types(df: DataFrame, names: Sequence[str]) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def run_generator(
    work: DataFrame, make: Callable[[], Generate], params: dict | None = None,
    keys: Sequence[str] = ("model", "pos"), partitions: int | None = None, batch_size: int = 32,
) -> DataFrame:
    """``(keys, text, status, elapsed)`` for a work list with ``model`` and ``prompt``.

    The hook is called with at most ``batch_size`` prompts; ``elapsed`` is a row's share of its
    own call. After a call that raises, only its rows are asked again, one by one. A row that
    raises or returns nothing gets status ``failed`` and NULL text, so it stays pending for the
    next run.
    """
    keys, options = list(keys), dict(params or {})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generate = make()
        for pdf in batches:
            texts, elapsed = [], []
            prompts, models = pdf["prompt"].tolist(), pdf["model"].tolist()
            for call in _calls(len(pdf), batch_size):
                started = time.monotonic()
                given = _answers(lambda asked, of: generate(asked, of, options), prompts[call], models[call])
                texts += [t.strip() if t else None for t in given]
                elapsed += [(time.monotonic() - started) / (call.stop - call.start)] * (call.stop - call.start)
            out = pdf[keys].copy()
            out["text"], out["status"], out["elapsed"] = texts, ["ok" if t else "failed" for t in texts], elapsed
            yield out

    columns = list(dict.fromkeys([*keys, "model", "prompt"]))
    rows = work.select(*columns)
    if partitions:
        rows = rows.repartition(partitions, *keys)
    return rows.mapInPandas(run, f"{_types(work, keys)}, text string, status string, elapsed double")


def encode_texts(
    texts: DataFrame, make: Callable[[], Encode], text: str = "text", batch_size: int = 64
) -> DataFrame:
    """``(digest, vector)`` of distinct texts. Join back with ``sha2(text, 256)``: a text that
    fills a third of the table is encoded once. A text the encoder fails on, alone and in its
    batch, has a NULL vector."""
    distinct = texts.select(F.sha2(text, 256).alias("digest"), F.col(text).alias("text")).filter(
        F.col(text).isNotNull()
    ).dropDuplicates(["digest"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = make()
        for pdf in batches:
            texts = pdf["text"].tolist()
            vectors = [v for call in _calls(len(texts), batch_size) for v in _answers(encode, texts[call])]
            yield pd.DataFrame({"digest": pdf["digest"], "vector": [None if v is None else list(v) for v in vectors]})

    return distinct.mapInPandas(run, "digest string, vector array<float>")


def run_judge(
    prompts: DataFrame, make: Callable[[], Judge], keys: Sequence[str] = ("title", "side", "metric"),
    attempts: int = 3, batch_size: int = 32,
) -> DataFrame:
    """``(keys, attempt, response)``: one row per call, asking again only for prompts whose
    answer had no score that ``judge_score`` reads."""
    keys = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = make()
        for batch in batches:
            prompts = batch.column(len(keys)).to_pylist()
            rows, numbers, responses = [], [], []
            for call in _calls(len(prompts), batch_size):
                waiting = list(range(call.start, call.stop))
                for attempt in range(1, attempts + 1):
                    if not waiting:
                        break
                    answers = _answers(lambda asked: judge(asked, attempt), [prompts[i] for i in waiting])  # noqa: B023
                    rows += waiting
                    numbers += [attempt] * len(waiting)
                    responses += answers
                    waiting = [i for i, a in zip(waiting, answers, strict=True) if not has_score(a)]
            asked = batch.select(range(len(keys))).take(pa.array(rows, pa.int64()))
            columns = [*asked.columns, pa.array(numbers, pa.int32()), pa.array(responses, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "attempt", "response"])

    return prompts.select(*keys, "prompt").mapInArrow(
        run, f"{_types(prompts, keys)}, attempt int, response string"
    )


def run_evaluator(
    inputs: DataFrame, make: Callable[[], Evaluate], dimensions: Sequence[str], keys: Sequence[str] = ("pos",),
    batch_size: int = 32,
) -> DataFrame:
    """``(keys, dimension, score)`` for every input and dimension.

    ``inputs`` has ``source``, ``system_output`` and ``reference``. The hook returns one score
    for each dimension; a failed input and a missing dimension give a NULL score.
    """
    keys, wanted = list(keys), list(dimensions)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        evaluate = make()
        for pdf in batches:
            columns = [pdf[c].tolist() for c in ("source", "system_output", "reference")]
            calls = _calls(len(pdf), batch_size)
            scores = [s or {} for call in calls for s in _answers(evaluate, *[c[call] for c in columns])]
            for name in wanted:
                out = pdf[keys].copy()
                out["dimension"] = name
                out["score"] = pd.array([s.get(name) for s in scores], dtype="Float64")
                yield out

    rows = inputs.select(*keys, "source", "system_output", "reference")
    return rows.mapInPandas(run, f"{_types(inputs, keys)}, dimension string, score double")


def _digest(text: str) -> str:
    return hashlib.md5(text.encode("utf-8")).hexdigest()


def stub_generator() -> Generate:
    """Answers with a digest of model and prompt; fails when the digest starts with 0."""

    def generate(prompts: Sequence[str], models: Sequence[str], options: dict) -> list[str | None]:
        digests = [_digest(f"{m}|{p}") for m, p in zip(models, prompts)]
        return [None if d[0] == "0" else f" abstract {d}\n" for d in digests]

    return generate


def stub_encoder() -> Encode:
    """Sixteen numbers between 0 and 255 from a digest of the text."""
    return lambda texts: [[float(b) for b in bytes.fromhex(_digest(t))] for t in texts]


def stub_judge() -> Judge:
    """Score 1, 2 or 3 from a digest of attempt and prompt; no score when it starts with 0-7."""

    def judge(prompts: Sequence[str], attempt: int) -> list[str | None]:
        digests = [_digest(f"{attempt}|{p}") for p in prompts]
        return ["no answer" if d[0] < "8" else f'{{"score": {1 + int(d[1], 16) % 3}}}' for d in digests]

    return judge


def stub_evaluator() -> Evaluate:
    """Scores in [0, 1] from a digest of output and dimension."""

    def evaluate(sources: Sequence[str], outputs: Sequence[str], references: Sequence[str]) -> list[dict[str, float]]:
        names = ("coherence", "consistency", "fluency", "relevance")
        return [{n: int(_digest(f"{n}|{o}")[:4], 16) / 65535 for n in names} for o in outputs]

    return evaluate
