"""Judge scoring: prompt table, response table, all-or-nothing records, means."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.functions.text import judge_score, render_template, source_article, strip_reasoning
from folioframe.operators.filters import scorable
from folioframe.operators.pairing import first_usable_attempt

# Judged qualities, their top scores and the two judged texts.
TOP_SCORES = {"coherence": 5, "consistency": 5, "fluency": 3, "relevance": 5}
SIDES = {"original": "Original", "generated": "Generated"}
MAX_ATTEMPTS = 3


@dataclass(frozen=True)
class JudgeTemplate:
    """Prompt with ``{content}``, ``{side}``, ``{abstract}`` and ``{top}`` placeholders."""

    text: str
    needs_content: bool = True


def judge_questions(
    articles: DataFrame, metrics: Sequence[str] = tuple(TOP_SCORES), keys: Sequence[str] = ("title",),
    done: DataFrame | None = None,
) -> DataFrame:
    """Article rows times their open questions ``(metric, side, max_score)``.

    The questions are a literal array, so no join builds the product. With ``done``, a table
    of answered ``(keys, side, metric)``, the answers are gathered per article (one entry per
    question at most): each article is shuffled once, not once per question.
    """
    cells = [
        F.struct(F.lit(m).alias("metric"), F.lit(s).alias("side"), F.lit(TOP_SCORES[m]).alias("max_score"))
        for m in metrics
        for s in SIDES
    ]
    questions = F.array(*cells)
    if done is None:
        return articles.select("*", F.inline(questions))
    name = F.concat_ws("/", "metric", "side")
    known = (
        done.filter(F.col("metric").isin(*metrics) & F.col("side").isin(*SIDES))
        .groupBy(*keys)
        .agg(F.collect_set(name).alias("_done"))
    )
    answered = F.coalesce("_done", F.array().cast("array<string>"))
    left = F.filter(questions, lambda q: ~F.array_contains(answered, F.concat_ws("/", q["metric"], q["side"])))
    return articles.join(known, list(keys), "left").select("*", F.inline(left)).drop("_done")


def judge_prompts(
    articles: DataFrame, templates: Mapping[str, JudgeTemplate], keys: Sequence[str] = ("title",),
    done: DataFrame | None = None,
) -> DataFrame:
    """``(keys, metric, side, max_score, prompt)`` of the open questions of every article."""
    prompt = F.lit(None).cast("string")
    for metric, template in templates.items():
        for side, label in SIDES.items():
            fields = {"side": F.lit(label), "abstract": F.col(f"{side}_abstract"), "top": F.lit(str(TOP_SCORES[metric]))}
            if template.needs_content:
                fields["content"] = F.col("content")
            asked = (F.col("metric") == metric) & (F.col("side") == side)
            prompt = F.when(asked, render_template(template.text, fields)).otherwise(prompt)
    open_questions = judge_questions(articles, tuple(templates), keys, done)
    return open_questions.select(*keys, "metric", "side", "max_score", prompt.alias("prompt"))


def accepted_scores(responses: DataFrame, keys: Sequence[str] = ("title",)) -> DataFrame:
    """``(keys, side, metric, score)`` from ``(…, attempt, response)`` rows: the first answer
    with a score within the allowed attempts."""
    parsed = responses.select(*keys, "side", "metric", "attempt", judge_score("response").alias("score"))
    return first_usable_attempt(parsed, [*keys, "side", "metric"], "score", limit=MAX_ATTEMPTS)


def complete_records(
    scores: DataFrame, keys: Sequence[str] = ("title",), metrics: Sequence[str] = tuple(TOP_SCORES),
    sides: Sequence[str] = tuple(SIDES),
) -> DataFrame:
    """One row per article with all scores of both sides; articles missing any are dropped."""
    cells = {
        f"{side}_{metric}": F.max(F.when((F.col("side") == side) & (F.col("metric") == metric), F.col("score")))
        for side in sides
        for metric in metrics
    }
    wide = scores.groupBy(*keys).agg(*[value.alias(name) for name, value in cells.items()])
    return wide.dropna(subset=list(cells))


def judge_means(
    records: DataFrame, metrics: Sequence[str] = tuple(TOP_SCORES), sides: Sequence[str] = tuple(SIDES)
) -> DataFrame:
    """``(side, metric, average_score, n_articles)``; no rows when there are no records."""
    cells = [
        F.struct(F.lit(s).alias("side"), F.lit(m).alias("metric"), F.col(f"{s}_{m}").alias("score"))
        for s in sides
        for m in metrics
    ]
    long = records.select(F.inline(F.array(*cells)))
    return long.groupBy("side", "metric").agg(
        F.avg("score").alias("average_score"), F.count(F.lit(1)).alias("n_articles")
    )


def nested_records(records: DataFrame, texts: DataFrame, key: str = "title") -> DataFrame:
    """Records in the nested result shape, each side with its text and scores."""
    shaped = [
        F.struct(
            F.col(f"{side}_abstract").alias("text"),
            F.struct(*[F.col(f"{side}_{m}").alias(f"{m}_score") for m in TOP_SCORES]).alias("scores"),
        ).alias(f"{side}_abstract")
        for side in SIDES
    ]
    return records.join(texts.select(key, "original_abstract", "generated_abstract"), key).select(key, *shaped)


def evaluator_inputs(pairs: DataFrame, keys: Sequence[str] = ("pos",)) -> DataFrame:
    """``(keys, source, system_output, reference)`` of the pairs that can be scored."""
    return scorable(pairs).select(
        *keys,
        source_article("title", "content").alias("source"),
        strip_reasoning("generated_abstract").alias("system_output"),
        F.col("original_abstract").alias("reference"),
    )


def evaluator_means(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by, dimension, average_score, n_scored)`` from ``(…, dimension, score)`` rows."""
    return scores.where("score IS NOT NULL").groupBy(*by, "dimension").agg(
        F.avg("score").alias("average_score"), F.count(F.lit(1)).alias("n_scored")
    )
