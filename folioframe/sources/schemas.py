"""Explicit schemas of the data model, and field checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Field names of the exchanged files.
ARTICLES = "title string, abstract string, content string"
ARTICLES_WITH_SECTIONS = "title string, abstract string, sections array<string>"
GENERATED = "title string, original_abstract string, generated_abstract string"
GENERATED_SHORT = "title string, abstract string"
CONVERSATIONS = "conversations array<struct<role:string,content:string>>"
CONVERSATIONS_FROM = "conversations array<struct<`from`:string,value:string>>"
MANIFEST = "normalized_name string, page_count int, file_id string"
JUDGE_SCORES = "struct<coherence_score:int,consistency_score:int,fluency_score:int,relevance_score:int>"
JUDGE_RESULTS = (
    f"title string, original_abstract struct<text:string,scores:{JUDGE_SCORES}>, "
    f"generated_abstract struct<text:string,scores:{JUDGE_SCORES}>"
)
GENERATION_CHECKPOINT = f"model_name string, last_processed_idx int, abstracts array<struct<{GENERATED}>>"

# The registered generation models.
MODELS = {
    1: ("smollm2:1.7b", "smollm2 1.7B"),
    2: ("qwen2.5:1.5b", "qwen 2.5 1.5B"),
    3: ("qwen2.5:3b", "qwen 2.5 3B"),
    4: ("llama3.2:3b", "llama3.2 3B"),
    5: ("gemma2:2b", "Gemma 2:2B"),
    6: ("phi4-mini", "Phi4-mini 3.8B"),
    7: ("qwen2.5:7b", "qwen 2.5 7B"),
    8: ("llama3.1:8b", "llama3.1 8B"),
    9: ("qwen2.5:14b", "qwen 2.5 14B"),
    10: ("deepseek-r1:8b", "deepseek-r1 8B"),
    11: ("qwen2.5:32b", "qwen 2.5 32B"),
}


def model_names() -> list[str]:
    """Registered model names in registry order."""
    return [name for _, (name, _) in sorted(MODELS.items())]


def model_registry(spark) -> DataFrame:
    """``(model_id, name, display_name)`` ordered by id."""
    rows = [(i, name, shown) for i, (name, shown) in MODELS.items()]
    return spark.createDataFrame(rows, "model_id int, name string, display_name string").orderBy("model_id")


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same frame; raises when a required field is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"missing fields: {', '.join(missing)}")
    return df


def with_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Missing and null fields replaced by their defaults."""
    for name, value in defaults.items():
        known = F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
        df = df.withColumn(name, known)
    return df


def generated_form(df: DataFrame) -> DataFrame:
    """Generated list with its text in ``generated_abstract``, whichever form it came in."""
    return df if "generated_abstract" in df.columns else df.withColumnRenamed("abstract", "generated_abstract")


def content_form(df: DataFrame) -> DataFrame:
    """Article list with ``content``, joined from ``sections`` in the older form."""
    if "content" in df.columns:
        return df
    return df.withColumn("content", F.array_join("sections", " ")).drop("sections")
