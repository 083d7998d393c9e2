"""Resumable generation run: work list, prompts, hook, results, publishing gate."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.functions.text import default_field, render_template
from folioframe.operators.corpus import publishable
from folioframe.operators.hooks import Generate, run_generator
from folioframe.operators.pairing import work_list
from folioframe.streaming.incremental import append_unseen, read_table

# Defaults of missing article fields.
NO_TITLE = "No Title"
RESULTS = "model string, pos bigint, text string, status string, elapsed double"


def prompt_table(work: DataFrame, template: str) -> DataFrame:
    """Add ``prompt`` from a template over ``{title}`` and ``{content}``."""
    fields = {"title": default_field("title", NO_TITLE), "content": default_field("content", "")}
    return work.withColumn("prompt", render_template(template, fields))


def generate_missing(
    articles: DataFrame, models: Sequence[str], template: str, make: Callable[[], Generate],
    path: str, params: dict | None = None,
) -> DataFrame:
    """Generate what the result table at ``path`` lacks, append it and return the table.

    Failed rows are not stored, so they are pending again in the next run.
    """
    spark = articles.sparkSession
    work = prompt_table(work_list(articles, models, read_table(spark, path, RESULTS)), template)
    answered = run_generator(work, make, params).filter(F.col("status") == "ok")
    append_unseen(answered, path, ["model", "pos"])
    return read_table(spark, path, RESULTS)


def published(results: DataFrame, articles: DataFrame) -> DataFrame:
    """``(model, pos, title, original_abstract, generated_abstract)`` of complete models."""
    return publishable(results, articles).join(
        articles.select("pos", "title", F.col("abstract").alias("original_abstract")), "pos"
    ).select("model", "pos", "title", "original_abstract", F.col("text").alias("generated_abstract"))
