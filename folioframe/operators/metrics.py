"""Text-generation quality metrics over a pair table, and their roll-ups."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.functions.overlap import PLAIN, gram_array, overlap_of_texts, shared
from folioframe.functions.text import shifted, split_words, word_text, words
from folioframe.functions.vectors import cosine
from folioframe.operators.hooks import Encode
from folioframe.operators.vector_store import store_vectors
from folioframe.session import cut, scratch_path

# Fixed value: label of the appended summary record.
SUMMARY = "Overall Metrics"


def f_measure(precision: Column, recall: Column) -> Column:
    total = precision + recall
    return F.when(total > 0, 2 * precision * recall / total).otherwise(F.lit(0.0))


def scores(prefix: str, hits: Column, n_reference: Column, n_candidate: Column) -> list[Column]:
    """Precision, recall and F columns from an overlap and two sizes; empty sides give 0."""
    precision = hits / F.greatest(n_candidate, F.lit(1))
    recall = hits / F.greatest(n_reference, F.lit(1))
    return [
        precision.alias(f"{prefix}_precision"),
        recall.alias(f"{prefix}_recall"),
        f_measure(precision, recall).alias(f"{prefix}_f"),
    ]


def overlaps(
    pairs: DataFrame, keys: Sequence[str], reference: str, candidate: str, sizes: Sequence[int] = (1,),
    distinct: bool = False, longest: bool = False, stemmed: bool = False, plain: bool = False,
) -> DataFrame:
    """``(keys, hits_n, ref_n, cand_n, ..., lcs)``: n-gram overlap per pair, without an exchange; ``lcs`` and, with ``plain``,
    the counts of unstemmed unigrams if asked for.

    Pairs stay in the partitions they come in; a caller whose pairs come from few files or
    differ much in cost repartitions them first.
    """
    measured = overlap_of_texts(reference, candidate, sizes, distinct, longest, stemmed, plain)
    return pairs.select(*keys, measured.alias("_overlap")).select(*keys, "_overlap.*")


def token_texts(pairs: DataFrame, keys: Sequence[str], reference: str, candidate: str) -> DataFrame:
    """``(keys, ref, cand)`` texts of space-separated tokens.

    Pairs stay in the partitions they come in; a caller whose pairs come from few files or
    differ much in cost repartitions them first.
    """
    raw = pairs.select(*keys, F.col(reference).alias("_r"), F.col(candidate).alias("_c"))
    return raw.select(
        *keys,
        F.coalesce(word_text("_r"), F.lit("")).alias("ref"),
        F.coalesce(word_text("_c"), F.lit("")).alias("cand"),
    )


def ngram_overlap(texts: DataFrame, keys: Sequence[str], sizes: Sequence[int] = (1,)) -> DataFrame:
    """``(keys, hits_n, ref_n, cand_n, ...)``: n-gram overlap per pair in built-in expressions, without an exchange."""
    arrays, totals = [], []
    for n in sizes:
        ref, cand = f"_ref_{n}", f"_cand_{n}"
        arrays += [gram_array("ref", n).alias(ref), gram_array("cand", n).alias(cand)]
        totals += [shared(ref, cand).alias(f"hits_{n}"), F.size(ref).alias(f"ref_{n}"), F.size(cand).alias(f"cand_{n}")]
    tokens = texts.select(*keys, split_words("ref").alias("ref"), split_words("cand").alias("cand"))
    return tokens.select(*keys, *arrays).select(*keys, *totals)


def ngram_scores(prefix: str, n: int) -> list[Column]:
    return scores(prefix, F.col(f"hits_{n}"), F.col(f"ref_{n}"), F.col(f"cand_{n}"))


def ngram_counts(df: DataFrame, text: str, n: int) -> DataFrame:
    """``(gram, n_uses)`` over all texts. Counting is combined before the shuffle, so frequent
    n-grams are no hot keys."""
    names = [f"w{i}" for i in range(n)]
    tokens = df.select(words(text).alias("_tokens"))
    rows = tokens.select(F.explode(shifted("_tokens", n)).alias("_gram")).select("_gram.*")
    counts = rows.dropna(subset=names).groupBy(*names).agg(F.count(F.lit(1)).alias("n_uses"))
    return counts.select(F.concat_ws(" ", *names).alias("gram"), "n_uses")


def rouge_n(
    pairs: DataFrame, sizes: int | Sequence[int], keys: Sequence[str] = ("pair_id",),
    reference: str = "reference_text", candidate: str = "candidate_text", stemmed: bool = False,
) -> DataFrame:
    """ROUGE-N precision, recall and F per pair, for one or several N."""
    sizes = [sizes] if isinstance(sizes, int) else list(sizes)
    if stemmed:
        overlap = overlaps(pairs, keys, reference, candidate, sizes, stemmed=True)
    else:
        overlap = ngram_overlap(token_texts(pairs, keys, reference, candidate), keys, sizes)
    return overlap.select(*keys, *[c for n in sizes for c in ngram_scores(f"rouge{n}", n)])


def unigram_scores(
    pairs: DataFrame, keys: Sequence[str] = ("pair_id",), reference: str = "reference_text",
    candidate: str = "candidate_text", distinct: bool = False, counted: bool = False,
) -> DataFrame:
    """Unigram precision, recall and F1, on multisets or on sets of words; of ``counted`` pairs from their ``PLAIN`` counts."""
    if counted:
        return pairs.select(*keys, *scores("unigram", *[F.col(c) for c in PLAIN]))
    overlap = overlaps(pairs, keys, reference, candidate, distinct=distinct)
    return overlap.select(*keys, *ngram_scores("unigram", 1))


def rouge_l(
    pairs: DataFrame, keys: Sequence[str] = ("pair_id",), reference: str = "reference_text",
    candidate: str = "candidate_text", stemmed: bool = False,
) -> DataFrame:
    """ROUGE-L per pair: each whole text is one sequence."""
    overlap = overlaps(pairs, keys, reference, candidate, longest=True, stemmed=stemmed)
    return overlap.select(*keys, *scores("rougeL", F.col("lcs"), F.col("ref_1"), F.col("cand_1")))


def rouge(
    pairs: DataFrame, keys: Sequence[str] = ("pair_id",), reference: str = "reference_text",
    candidate: str = "candidate_text", stemmed: bool = True, plain: bool = False,
) -> DataFrame:
    """ROUGE-1, ROUGE-2 and ROUGE-L F per pair, from one pass over the texts; with ``plain`` also the counts for ``unigram_scores``."""
    overlap = overlaps(pairs, keys, reference, candidate, (1, 2), longest=True, stemmed=stemmed, plain=plain)
    one, two = ngram_scores("rouge1", 1), ngram_scores("rouge2", 2)
    longest = scores("rougeL", F.col("lcs"), F.col("ref_1"), F.col("cand_1"))
    return overlap.select(*keys, one[2].alias("rouge1"), two[2].alias("rouge2"), longest[2].alias("rougeL"), *(PLAIN if plain else ()))


def cosine_scores(
    vectors: DataFrame, keys: Sequence[str], first: str, second: str, name: str = "similarity"
) -> DataFrame:
    """Cosine similarity of two vector columns; an ``encoder`` among the keys gives one result
    set per encoder in the same plan."""
    return vectors.select(*keys, cosine(first, second).alias(name))


def similarity_of_texts(
    pairs: DataFrame, encoders: Mapping[str, Callable[[], Encode]], keys: Sequence[str] = ("pair_id",),
    reference: str = "reference_text", candidate: str = "candidate_text", store: str | None = None,
) -> DataFrame:
    """``(keys, encoder, similarity)``: cosine of both texts of every pair, by every encoder.

    Vectors come from the store at ``store`` (``vector_store``), into which distinct texts that it
    lacks are encoded first; without one from a new store in the shared folder. Both sides read it by
    digest. A pair with a null text, or one that an encoder failed on, has a NULL similarity.
    """
    texts = pairs.select(F.col(reference).alias("text")).union(pairs.select(F.col(candidate).alias("text")))
    vectors = store_vectors(texts, encoders, store or scratch_path(pairs.sparkSession, "vectors"))
    names = F.explode(F.array(*[F.lit(name) for name in encoders])).alias("encoder")
    sides = pairs.select(*keys, F.sha2(reference, 256).alias("_ref"), F.sha2(candidate, 256).alias("_cand"), names)
    first = vectors.select(F.col("digest").alias("_ref"), "encoder", F.col("vector").alias("_ref_vector"))
    second = vectors.select(F.col("digest").alias("_cand"), "encoder", F.col("vector").alias("_cand_vector"))
    joined = sides.join(first, ["_ref", "encoder"], "left").join(second, ["_cand", "encoder"], "left")
    return cosine_scores(joined, [*keys, "encoder"], "_ref_vector", "_cand_vector")


def _unit_rows(vectors: pa.ChunkedArray) -> np.ndarray:
    """The vectors as rows of length one, zero vectors as they are."""
    lists = vectors.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    rows = flat.reshape(len(lists), -1).astype("float64")
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def best_matches(a: np.ndarray, b: np.ndarray, tile: int) -> tuple[np.ndarray, np.ndarray]:
    """The highest product of each row of ``a`` with rows of ``b``, and the other way round, tile by tile."""
    best_a, best_b = np.full(len(a), -np.inf), np.full(len(b), -np.inf)
    for i in range(0, len(a), tile):
        for j in range(0, len(b), tile):
            similar = a[i : i + tile] @ b[j : j + tile].T
            np.maximum(best_a[i : i + tile], similar.max(axis=1), out=best_a[i : i + tile])
            np.maximum(best_b[j : j + tile], similar.max(axis=0), out=best_b[j : j + tile])
    return best_a, best_b


def bert_score(
    tokens: DataFrame, keys: Sequence[str] = ("pair_id",), side: str = "side", tok: str = "tok",
    vector: str = "vec", block: int = 512, pairs: DataFrame | None = None,
) -> DataFrame:
    """BERTScore precision, recall and F1 per pair from token vectors.

    ``pairs`` is the table of all pairs; those without tokens on a side score 0. Without it the
    pairs are those that have a token. ``side`` is ``reference`` or ``candidate``; precision
    averages over candidate tokens; a token number that comes twice on a side counts by its best.

    Both sides are dealt by pair and meet in one task, so each vector is shuffled once. There they
    are two matrices, compared in tiles of ``block`` by ``block`` tokens whose maxima are kept as they come; a
    pair gives one row. Beside a tile a task holds the vectors of one pair.
    """
    keys = list(keys)
    rows = tokens.select(*keys, side, F.col(tok).alias("_tok"), F.col(vector).alias("_vec")).where(F.col("_vec").isNotNull())
    reference, candidate = (rows.where(F.col(side) == value).drop(side) for value in ("reference", "candidate"))
    # names of their own, so that the two sides of one table can meet
    candidate = candidate.select(
        *[F.col(k).alias(f"_cand_{i}") for i, k in enumerate(keys)], F.col("_tok").alias("_cand_tok"), F.col("_vec").alias("_cand_vec")
    )
    types = [f"`{k}` {tokens.schema[k].dataType.simpleString()}" for k in keys]

    def mean(numbers: pa.ChunkedArray, best: np.ndarray) -> float:
        _, place = np.unique(numbers.to_numpy(zero_copy_only=False), return_inverse=True)
        by_token = np.full(place.max() + 1, -np.inf)
        np.maximum.at(by_token, place, best)
        return float(by_token.mean())

    def compare(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        precision = recall = 0.0
        if left.num_rows and right.num_rows:
            best_ref, best_cand = best_matches(_unit_rows(left.column("_vec")), _unit_rows(right.column("_cand_vec")), block)
            precision, recall = mean(right.column("_cand_tok"), best_cand), mean(left.column("_tok"), best_ref)
        return pa.table({
            **{name: pa.array([value.as_py()], value.type) for name, value in zip(keys, key, strict=True)},
            "bert_precision": [precision], "bert_recall": [recall],
        })

    cogrouped = reference.groupBy(*keys).cogroup(candidate.groupBy(*[f"_cand_{i}" for i in range(len(keys))]))
    means = cogrouped.applyInArrow(compare, ", ".join([*types, "bert_precision double", "bert_recall double"]))
    if pairs is not None:
        means = pairs.select(*keys).distinct().join(means, keys, "left")
    p, r = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("bert_precision", "bert_recall"))
    return means.select(
        *keys, p.alias("bert_precision"), r.alias("bert_recall"),
        F.when(p + r != 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)).alias("bert_f1"),
    )


def roll_up(df: DataFrame, metrics: Sequence[str], by: Sequence[str] = (), prefix: str = "average_") -> DataFrame:
    """Means of per-pair metrics, over all pairs or per model, encoder, ..."""
    return df.groupBy(*by).agg(
        *[F.avg(m).alias(f"{prefix}{m}") for m in metrics], F.count(F.lit(1)).alias("n_pairs")
    )


def roll_up_with_total(
    df: DataFrame, metrics: Sequence[str], by: Sequence[str], prefix: str = "average_"
) -> DataFrame:
    """Means per group and the overall record (``summary`` set) in one pass."""
    means = [F.avg(m).alias(f"{prefix}{m}") for m in metrics]
    grouped = df.groupingSets([[F.col(b) for b in by], []], *by).agg(
        *means, F.count(F.lit(1)).alias("n_pairs"), F.when(F.grouping_id() > 0, F.lit(SUMMARY)).alias("summary")
    )
    return grouped


def with_summary(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Metric rows followed by one ``{summary, average_*}`` row with its own columns.

    The rows are written to the shared folder first: they are small beside the texts they were
    computed from, and without it the metric would run once for the rows and again for the mean.
    """
    rows, _ = cut(df, "metric")
    means = rows.agg(*[F.avg(m).alias(f"average_{m}") for m in metrics])
    return rows.unionByName(means.withColumn("summary", F.lit(SUMMARY)), allowMissingColumns=True)


def benchmark_table(roll_ups: Mapping[str, DataFrame], by: Sequence[str] = ("model",)) -> DataFrame:
    """One row per model with every metric's mean; a model missing in one roll-up keeps NULL."""
    tagged = [df.drop("n_pairs") for df in roll_ups.values()]
    return reduce(lambda x, y: x.join(y, list(by), "full"), tagged)
