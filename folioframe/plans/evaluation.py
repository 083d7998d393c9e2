"""Scoring pipelines: several metrics of one pair table, rolled up per model; judge runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.operators.hooks import Encode, Evaluate, Judge, run_evaluator, run_judge
from folioframe.operators.judging import (
    accepted_scores, complete_records, evaluator_inputs, evaluator_means, judge_means, judge_prompts,
)
from folioframe.operators.metrics import (
    benchmark_table, bert_score, cosine_scores, roll_up, rouge, similarity_of_texts, unigram_scores, with_summary,
)
from folioframe.session import cut, discard
from folioframe.streaming.incremental import append_unseen, read_table


def rouge_report(
    pairs: DataFrame, keys: Sequence[str], reference: str, candidate: str, stemmed: bool = True
) -> DataFrame:
    """ROUGE-1/2/L per pair and the summary record."""
    metrics = ["rouge1", "rouge2", "rougeL"]
    return with_summary(rouge(pairs, keys, reference, candidate, stemmed), metrics)


def model_benchmark(
    pairs: DataFrame, vectors: DataFrame, model: str = "model", key: str = "pair_id",
    stemmed: bool = True,
) -> DataFrame:
    """One row per model: mean ROUGE and mean embedding similarity."""
    keys = [model, key]
    texts = roll_up(rouge(pairs, keys, stemmed=stemmed), ["rouge1", "rouge2", "rougeL"], [model])
    similar = roll_up(cosine_scores(vectors, keys, "reference_vector", "candidate_vector"), ["similarity"], [model])
    return benchmark_table({"rouge": texts, "similarity": similar}, [model])


def model_table(
    pairs: DataFrame, encoders: Mapping[str, Callable[[], Encode]], tokens: DataFrame | None = None,
    judged: DataFrame | None = None, evaluated: DataFrame | None = None, model: str = "model", key: str = "pair_id",
    dimensions: Sequence[str] = (), stemmed: bool = True, store: str | None = None,
) -> DataFrame:
    """One row per model with the mean of every metric.

    ROUGE-1/2/L and unigram F come from the texts, ``similarity_<encoder>`` from the encoders, by way
    of the vector table at ``store``.
    ``tokens`` (vectors by ``model, key, side, tok``) adds BERTScore over all pairs, ``judged``
    (``model`` and score columns) judge means, ``evaluated`` (``model, dimension, score``) a
    column for each of ``dimensions``. Both text metrics come from one pass over the texts, whose means are written
    to the shared folder: they are one row a model, and else each would run that pass again.
    """
    keys, longer = [model, key], ["rouge1", "rouge2", "rougeL"]
    scored = unigram_scores(rouge(pairs, keys, stemmed=stemmed, plain=True), [*keys, *longer], counted=True)
    means, _ = cut(roll_up(scored, [*longer, "unigram_f"], [model]), "means")
    parts = {"rouge": means.drop("average_unigram_f"), "unigram": means.select(model, "average_unigram_f", "n_pairs")}
    similar = similarity_of_texts(pairs, encoders, keys, store=store)
    cells = [F.avg(F.when(F.col("encoder") == name, F.col("similarity"))).alias(f"average_similarity_{name}") for name in encoders]
    parts["similarity"] = similar.groupBy(model).agg(*cells, F.count(F.lit(1)).alias("n_pairs"))
    if tokens is not None:
        parts["bert"] = roll_up(bert_score(tokens, keys, pairs=pairs), ["bert_precision", "bert_recall", "bert_f1"], [model])
    if judged is not None:
        parts["judge"] = roll_up(judged, [c for c in judged.columns if c not in (model, key)], [model])
    if evaluated is not None:
        means = [F.avg(F.when(F.col("dimension") == d, F.col("score"))).alias(f"average_{d}") for d in dimensions]
        parts["evaluator"] = evaluated.groupBy(model).agg(*means, F.count(F.lit(1)).alias("n_pairs"))
    return benchmark_table(parts, [model])


def judge_report(articles: DataFrame, templates, ask, keys: Sequence[str] = ("title",)) -> DataFrame:
    """Judge means per side and quality. ``ask`` turns the prompt table into responses.

    The responses are written to the shared folder: a judge must not be called again when a later
    stage is recomputed.
    """
    responses, _ = cut(ask(judge_prompts(articles, templates, keys)), "responses")
    return judge_means(complete_records(accepted_scores(responses, keys), keys))


def judge_missing(
    articles: DataFrame, templates, make: Callable[[], Judge], path: str, keys: Sequence[str] = ("title",),
) -> DataFrame:
    """Ask the questions that the score table at ``path`` lacks, append the scores, return the table.

    The raw responses are written first, so no later stage that is run again asks the judge again.
    Only scored answers are stored, so a question without one is open again in the next run.
    """
    spark, asked = articles.sparkSession, [*keys, "side", "metric"]
    types = ", ".join(f"{k} {articles.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{types}, side string, metric string, score int"
    prompts = judge_prompts(articles, templates, keys, read_table(spark, path, schema))
    responses, response_path = cut(run_judge(prompts, make, asked), "responses")
    append_unseen(accepted_scores(responses, keys), path, asked)
    discard(spark, response_path)
    return read_table(spark, path, schema)


def evaluator_report(
    pairs: DataFrame, make: Callable[[], Evaluate], dimensions: Sequence[str], keys: Sequence[str] = ("pos",),
    by: Sequence[str] = (),
) -> DataFrame:
    """Mean evaluator score per dimension, over all scorable pairs or per model."""
    return evaluator_means(run_evaluator(evaluator_inputs(pairs, keys), make, dimensions, keys), by)
